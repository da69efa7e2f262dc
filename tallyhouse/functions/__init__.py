"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM-side,
inside whole-stage codegen; no Python UDFs)."""

from tallyhouse.functions.exprs import (  # noqa: F401
    blank,
    code_or,
    flag,
    initcap_words,
    month_of,
    month_index,
    parse_bool,
    retention_pct,
    status_norm,
    trimmed,
    try_date,
    try_num,
)
