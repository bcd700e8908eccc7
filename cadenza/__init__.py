"""cadenza: analytics over keyed, ordered signal timelines, written as Spark DataFrame plans."""

__version__ = "0.1.0"
