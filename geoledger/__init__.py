"""DataFrame operators that keep large tables of places correct and explorable on Spark."""
