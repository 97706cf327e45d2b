"""tidemark: state history over keyed snapshots, on Spark DataFrames."""

__version__ = "0.1.0"
