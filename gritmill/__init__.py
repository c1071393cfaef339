"""gritmill: from one wide, dirty fact table to a checked, modelled data set, on Spark."""

__version__ = "0.1.0"
