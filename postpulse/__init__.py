"""postpulse: Spark analytics for streams and tables of social posts and comments."""

__version__ = "0.1.0"
