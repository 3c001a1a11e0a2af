"""eventpulse: daily news-event analytics and table operators on PySpark."""
