"""Regional-statistics warehouse on Spark: sources, history, indicators, mart, queries."""
