"""rankloom: leaderboard ranking and content auditing as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
