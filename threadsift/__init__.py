"""threadsift: Spark jobs that find business deals in mail threads."""

__version__ = "0.1.0"
