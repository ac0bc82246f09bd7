"""DataFrame -> DataFrame operators. Lazy, except where a schema or a literal depends on data;
each such place runs aggregates that return one small row."""
