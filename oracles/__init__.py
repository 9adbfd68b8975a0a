"""Independent SQL for the registered queries, run by DuckDB over the same tables."""

from . import files, market, more, people, quality, reports, tools


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in (people, quality, tools, market, reports, files, more):
        out.update(module.SQL)
    return out
