"""Retail demand analytics and forecasting on Spark DataFrames."""

from demandloom.schemas import Period, SplitSpec
from demandloom.session import local_session

__all__ = ["Period", "SplitSpec", "local_session"]
