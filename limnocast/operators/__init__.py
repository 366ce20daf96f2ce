"""DataFrame operators: joins, reshaping, series, ranking, scoring, profiles."""
