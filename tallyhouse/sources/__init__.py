"""Where sales come from and where results go: source tables, landing files, exports."""
