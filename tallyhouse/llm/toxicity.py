"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import byte_slices, table, written

#: At most so many labelled rows fit the model, chosen by the hash of their id.
SAMPLE = 50_000
#: Bytes of text that are handled together.
MOST = 1 << 20
#: The prior's weight against the counts; how many standard deviations a log-odds must be from 0;
#: what each token costs, so that a chance segment's expected score is below 0; letters of a stem.
PRIOR, SURE, DRIFT, STEM = 0.02, 2.5, 0.25, 4
#: A token that was there within so many tokens before says nothing new.
NEAR = 32
#: A segment counts if fewer than this many as good are expected in a clean text of that length.
EXPECTED = 0.01

_WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Weights(dict):
    """The score of each token: its own log-odds, else those of its stem, else 0; less the drift."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        super().__init__()
        self.words, self.stems = words, stems

    def __missing__(self, word: str) -> float:
        got = self.words.get(word)
        if got is None:
            got = self.stems.get(word[:STEM], 0.0)
        if len(self) < 400_000:
            self[word] = got - DRIFT
        return got - DRIFT


@dataclass
class Model:
    """``decay`` and ``scale`` are lambda and K of E = K n exp(-lambda S); score = logistic(a + b x)."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1.0
    a: float = -4.0
    b: float = 0.0

    def log_expected(self, score: float, length: int) -> float:
        """Natural logarithm of how many segments as good a clean text of ``length`` tokens has."""
        return math.log(self.scale * max(length, 1)) - self.decay * score

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.a + self.b * evidence))))


def segments(scores: Sequence[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, sum), in one pass over ``scores``.

    A candidate keeps the running sum before it and after it, and which earlier candidate is the
    nearest that starts lower. A new one joins the nearest that starts lower, if the sum since has a
    new height; what lies between goes into it. The search jumps from candidate to candidate that
    starts lower still, and never meets again what it jumped over, so time is linear.
    """
    begin, end, low, high, lower = [], [], [], [], []
    total = 0.0
    for i, score in enumerate(scores):
        total += score
        if score <= 0:
            continue
        start, below, j = i, total - score, len(low) - 1
        while True:
            while j >= 0 and low[j] >= below:
                j = lower[j]
            if j < 0 or high[j] >= total:
                break
            start, below, next_lower = begin[j], low[j], lower[j]
            del begin[j:], end[j:], low[j:], high[j:], lower[j:]
            j = next_lower
        begin.append(start)
        end.append(i + 1)
        low.append(below)
        high.append(total)
        lower.append(j)
    return [(b, e, h - x) for b, e, x, h in zip(begin, end, low, high, strict=True)]


def passages(text: str, weights: Weights, model: Model) -> list[tuple[int, int, float, float]]:
    """The significant segments of a text: begin and end in code points, score, log E."""
    scores = list(map(weights.__getitem__, tokens(text)))
    if not scores or max(scores) <= 0:
        return []
    found = []
    spots = None
    for begin, end, score in segments(_once(scores, tokens(text))):
        log_e = model.log_expected(score, len(scores))
        if log_e < math.log(EXPECTED):
            spots = spots or _spots(text)
            found.append((spots[begin][0], spots[end - 1][1], score, log_e))
    return found


def _once(scores: list[float], words: list[str]) -> list[float]:
    """The scores, with only the drift for positive tokens that are repeated nearby."""
    last: dict[str, int] = {}
    out = []
    for i, (score, word) in enumerate(zip(scores, words, strict=True)):
        if score > 0:
            out.append(-DRIFT if i - last.get(word, -NEAR - 1) <= NEAR else score)
            last[word] = i
        else:
            out.append(score)
    return out


def _spots(text: str) -> list[tuple[int, int]]:
    lower = text.lower()
    if len(lower) == len(text):
        return [m.span() for m in _WORD.finditer(lower)]
    back = [i for i, c in enumerate(text) for _ in c.lower()]  # some letters become two
    return [(back[m.start()], back[m.end() - 1] + 1) for m in _WORD.finditer(lower)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, toxic, n): in how many texts words are, and stems with a ``*`` behind.

    Texts, not occurrences: a word that one long text repeats says little about its class.
    """
    for batch in (rows for whole in batches for rows in byte_slices(whole, 0, MOST)):
        for label in (0, 1):
            found = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if toxic == label:
                    words = set(tokens(text))
                    found.update(words)
                    found.update({w[:STEM] + "*" for w in words})
            both = list(found.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in both], pa.string()), pa.array([label] * len(both), pa.int32()), pa.array([n for _, n in both], pa.int64())],
                names=["token", "toxic", "n"],
            )


def _log_odds(counts: DataFrame) -> DataFrame:
    """Log-odds of each token between the classes under a Dirichlet prior centred on both, and z.

    A token's prior count is PRIOR times its count in all labelled texts.
    """
    by_token = counts.groupBy("token").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    totals = counts.where(~F.endswith("token", F.lit("*"))).agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("all_t"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("all_c"),
    ).first()
    prior, all_prior = PRIOR * (F.col("t") + F.col("c")), PRIOR * (totals.all_t + totals.all_c)

    def log_odds(own: str, total: int):
        # a token may be all there is of a class: keep the rest above 0
        return F.log((F.col(own) + prior) / F.greatest(total + all_prior - F.col(own) - prior, F.lit(1e-9)))

    odds = log_odds("t", totals.all_t) - log_odds("c", totals.all_c)
    spread = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))
    return by_token.select("token", odds.alias("odds"), (odds / spread).alias("z"))


def _lambda(clean: Counter) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1 over the scores of clean tokens."""
    values = np.array(list(clean))
    share = np.array([clean[x] for x in values], float)
    share /= share.sum()
    if values.max() <= 0 or share @ values >= 0:
        return 1.0
    low, high = 0.0, 1.0
    with np.errstate(over="ignore"):
        while share @ np.exp(high * values) < 1:
            low, high = high, 2 * high
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if share @ np.exp(mid * values) < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a and b of P(1) = 1 / (1 + exp(-a - b x)), by Newton's method with a small penalty on b."""
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    penalty = np.diag([1e-6, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - penalty @ beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of ``labels`` (id, toxic) over the texts of ``docs``, without the held-out rows.

    Rows with a null id or label teach nothing; of several labels of an id the higher counts. If a
    class is missing, the model scores every text by the share of toxic rows (smoothed).
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .where(~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = written(texts.join(F.broadcast(known), "id").select("text", "toxic"), "labelled")
    sizes = {x.toxic: x["count"] for x in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        share = (sizes.get(1, 0) + 0.02) / (sum(sizes.values()) + 1)
        return Model(a=math.log(share / (1 - share)))
    once = rows.dropDuplicates()  # copies of a text are one piece of evidence
    counts = written(once.mapInArrow(_count, "token string, toxic int, n long"), "tokens")
    sure = _log_odds(counts).where(F.abs("z") >= SURE)
    odds = {x.token: max(x.odds, -1.0) for x in sure.collect()}
    model = Model(
        words={w: x for w, x in odds.items() if not w.endswith("*")},
        stems={w[:-1]: x for w, x in odds.items() if w.endswith("*")},
    )
    seen = written(rows.mapInArrow(_profile(model), _PROFILE), "profile")
    clean = Counter({round(x.value, 6): x.n for x in seen.where("toxic = 0 and value is not null").groupBy("value").agg(F.sum("n").alias("n")).collect()})
    total = sum(clean.values())
    best = max([x for x in [*model.words.values(), *model.stems.values()] if x > 0], default=1.0) - DRIFT
    clean[round(best, 6)] += 1  # a score that clean texts happen not to have isn't impossible
    model.decay = _lambda(clean)
    weakest = min((x for x in clean if x > 0), default=1.0)
    found = seen.where("toxic = 0 and value is null").agg(F.sum("n")).first()[0] or 0
    model.scale = max((found + 1) / (max(total, 1) * math.exp(-model.decay * weakest)), 1e-3)
    judged = rows.mapInArrow(_evidence(model), "evidence double, toxic int").collect()  # SAMPLE rows at most
    model.a, model.b = _logistic(
        np.array([x.evidence for x in judged]), np.array([float(x.toxic == 1) for x in judged])
    )
    return model


_PROFILE = "toxic int, value double, n long"


def _profile(model: Model):
    """Counts of token scores by class; with a null value the count of maximal segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, out = Weights(model.words, model.stems), Counter()
        for batch in (rows for whole in batches for rows in byte_slices(whole, 0, MOST)):
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                scores = list(map(weights.__getitem__, tokens(text)))
                for value, n in Counter(scores).items():
                    out[toxic, value] += n
                if scores and max(scores) > 0:
                    out[toxic, None] += len(segments(_once(scores, tokens(text))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in out], pa.int32()), pa.array([k[1] for k in out], pa.float64()), pa.array(list(out.values()), pa.int64())],
            names=["toxic", "value", "n"],
        )

    return run


def _total(found: list[tuple[int, int, float, float]]) -> float:
    return math.log1p(sum(-x[3] for x in found))


def _evidence(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.words, model.stems)
        for batch in (rows for whole in batches for rows in byte_slices(whole, 0, MOST)):
            got = [_total(passages(x, weights, model)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, pa.float64()), batch.column(1)], names=["evidence", "toxic"]
            )

    return run


def held_out(id_column):
    return F.crc32(id_column.cast("string")) % 5 == 0


_SCORED = "score double, predicted int, passages array<struct<begin: int, end: int, score: double, log_expected: double>>"


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``score``, ``predicted``, ``passages`` that are significant.

    Places in ``passages`` are code points, end exclusive. The evidence of a text is the sum of its
    passages' -log E. A null or empty text has no passage, and the score of such texts. Repeated
    rows stay, an empty table gives no rows, other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.words, model.stems)
        for batch in (rows for whole in batches for rows in byte_slices(whole, 1, MOST)):
            found = [passages(x, weights, model) for x in batch.column(1).to_pylist()]
            score = np.array([model.score(_total(x)) for x in found], float)
            spans = [[dict(zip(names, x, strict=True)) for x in own] for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                names=["id", "score", "predicted", "passages"],
            )

    names = ["begin", "end", "score", "log_expected"]
    kind = pa.list_(pa.struct(list(zip(names, [pa.int32(), pa.int32(), pa.float64(), pa.float64()], strict=True))))
    id_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return slim.mapInArrow(run, f"id {id_type}, {_SCORED}").withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text the model doesn't call toxic.

    Only texts go to Python. Null and empty texts are scored as empty ones.
    """

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = Weights(model.words, model.stems)
        for batch in texts:
            yield pa.array([model.score(_total(passages(x.as_py() or "", weights, model))) for x in batch], pa.float64())

    return docs.where(score(F.col(text_col)) < 0.5)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted"
    )
