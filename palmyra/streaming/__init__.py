from palmyra.streaming.monthly import start_monthly_updates  # noqa: F401
