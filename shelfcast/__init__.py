"""shelfcast: retail demand forecasting and stock replenishment as Spark DataFrame jobs."""

__version__ = "0.1.0"
