"""DataFrame operators: joins, groupings, rankings and what is built on them."""
