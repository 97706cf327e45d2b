"""Change detection as a segmented scan: ranges cut keys and days anywhere, one scan, one shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, ts
from tidemark.operators.history import compress_history, changed_rows
from tidemark.schemas import PARENT, TIE, TS
from tidemark.session import scratch

KEYS = ["cliente", "folio_padre"]


def log(spark):
    """A hot key whose one day has most rows, keys with NULLs, NULL times and states, equal times, keys of one row."""
    rnd = random.Random(5)
    rows = [dict(cliente="hot", folio_padre="P", fecha_registro=ts(3), estado_padre=rnd.choice("aab")) for _ in range(400)]
    rows += [dict(cliente=rnd.choice(["1", "2", None]), folio_padre=rnd.choice(["P1", "P2", None]), fecha_registro=rnd.choice([None, ts(1), ts(2), ts(2, 5)]),
                  estado_padre=rnd.choice(["a", "b", None])) for _ in range(150)]
    rows += [dict(cliente="9", folio_padre=f"Q{k}") for k in range(20)]
    rnd.shuffle(rows)
    return raw_df(spark, rows)


def expected(rows):
    out, past = set(), {}
    for r in sorted(rows, key=lambda r: (r[TS] is None, r[TS] or ts(1), r[TIE])):
        key = tuple(r[k] for k in KEYS)
        if None in key or key not in past or r.estado_padre is None or past[key] is None or past[key] != r.estado_padre:
            out.add(r[TIE])
        past[key] = r.estado_padre
    return out


@pytest.mark.parametrize("ranges,batch", [(1, 10_000), (1, 1), (7, 3), (90, 10_000)])
def test_changes_do_not_depend_on_ranges_and_batches(spark, ranges, batch):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    df = log(spark)
    try:
        for c, v in zip(old, (ranges, "false", batch)):
            spark.conf.set(c, v)
        got = changed_rows(df, KEYS, "estado_padre")
        assert got.columns == df.columns
        rows = got.collect()
        assert len(rows) == len({r[TIE] for r in rows}) and {r[TIE] for r in rows} == expected(df.collect())
        assert changed_rows(df.limit(0), KEYS, "estado_padre").count() == 0
        with_more = {r[TIE] for r in changed_rows(df, KEYS, "estado_padre", always=F.col(TIE) % 3 == 0).collect()}
        assert with_more == expected(df.collect()) | {r[TIE] for r in df.collect() if r[TIE] % 3 == 0}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_one_scan_and_one_shuffle_of_the_log(spark):
    path = scratch(spark, "segmented")
    log(spark).write.parquet(path)
    history = compress_history(spark.read.parquet(path), PARENT)
    history.collect()
    lines, initial = [], None  # the final plans only
    for line in history._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :|+-"))
        if initial is None or at < initial:
            initial = at if "== Initial Plan ==" in line else None
            lines.append(line)
    final = "\n".join(lines)
    assert final.count("FileScan") == 1 and final.count("rangepartitioning") == 1 and final.count("Exchange hashpartitioning") == 1
    assert "_deal" in final.split("Exchange hashpartitioning")[1].split("\n")[0]
