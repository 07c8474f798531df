from telco_mart.functions import cleaning, keys  # noqa: F401
