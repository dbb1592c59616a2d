"""ticklake: DataFrame operators over recorded market-event tapes."""
