"""All registered queries with the SQL that checks them."""

from review_lens.plans import (
    label_queries,
    model_queries,
    quality_queries,
    record_queries,
    stream_queries,
)

REGISTERED = {}
for _module in (label_queries, record_queries, quality_queries, model_queries, stream_queries):
    REGISTERED.update(_module.QUERIES)


def queries():
    return {name: run for name, (run, _) in REGISTERED.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}
