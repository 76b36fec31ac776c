"""How often every term and n-gram occurs, and in how many records."""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.unpack import MISSING
from ..sources.scratch import default_parallelism

_TOKEN = re.compile(r"[a-z0-9]+")
#: Entries of a task's hash table of suffixes before it is spilled as partial states.
TABLE_ENTRIES = 150_000
FIELD_MISSING = {m for m in MISSING if m not in ("[]", "-")}


def _suffixes(fields: list[str], sigma: int):
    """Truncated suffixes of every value with mergeable counts: occurrences, and for every prefix length the records in which the prefix
    is met here for the first time."""
    schema = pa.schema([("field", pa.string()), ("suffix", pa.string()), ("cf", pa.int64()), *[(f"d{i}", pa.int64()) for i in range(1, sigma + 1)]])

    def flush(tables: list[dict]) -> Iterator[pa.RecordBatch]:
        for field, table in zip(fields, tables):
            if table:
                states = list(table.values())
                cols = [pa.array([field] * len(table)), pa.array(list(table)), *[pa.array([s[i] for s in states], pa.int64()) for i in range(sigma + 1)]]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
                table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: list[dict] = [{} for _ in fields]
        for batch in batches:
            for f, table in enumerate(tables):
                get = table.get
                for value in batch.column(f).to_pylist():
                    if value is None or value.strip().lower() in FIELD_MISSING:
                        continue
                    toks = _TOKEN.findall(value.lower())
                    seen: set = set()
                    for i in range(len(toks)):
                        cut = toks[i : i + sigma]
                        key = " ".join(cut)
                        state = get(key)
                        if state is None:
                            state = table[key] = [0] * (sigma + 1)
                        state[0] += 1
                        gram = ""
                        for n, t in enumerate(cut, 1):
                            gram = t if n == 1 else gram + " " + t
                            if gram not in seen:
                                seen.add(gram)
                                state[n] += 1
                    if len(table) > TABLE_ENTRIES:
                        yield from flush(tables)
        yield from flush(tables)

    return run


def _stack(sigma: int):
    """Over suffixes in descending order: a stack of the open prefixes; a prefix that the next suffix no longer has is complete."""
    schema = pa.schema([("field", pa.string()), ("term", pa.string()), ("n", pa.int32()), ("cf", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # [token, cf, df]
        out: list[tuple] = []
        field = None

        def close(depth: int) -> None:
            while len(stack) > depth:
                toks = [s[0] for s in stack]
                _, cf, df = stack.pop()
                out.append((field, " ".join(toks), len(toks), cf, df))
                if stack:
                    stack[-1][1] += cf

        for batch in batches:
            cols = batch.to_pydict()
            dcols = [cols[f"d{i}"] for i in range(1, sigma + 1)]
            for r, (fld, suffix, cf) in enumerate(zip(cols["field"], cols["suffix"], cols["cf"])):
                toks = suffix.split(" ")
                if fld != field:
                    close(0)
                    field = fld
                same = 0
                while same < len(stack) and same < len(toks) and stack[same][0] == toks[same]:
                    same += 1
                close(same)
                for t in toks[same:]:
                    stack.append([t, 0, 0])
                stack[-1][1] += cf
                for n in range(len(toks)):
                    stack[n][2] += dcols[n][r]
            if len(out) > 20_000:
                yield _batch(out, schema)
                out = []
        close(0)
        if out:
            yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(cols, schema)], schema=schema)


def ngram_counts(df: DataFrame, fields: list[str], sigma: int = 2, salt: int | None = None) -> DataFrame:
    """(field, term, n, cf, df): for every term of 1 to sigma tokens, its occurrences cf and the rows df that hold it.

    Tokens are runs of a-z and 0-9 of the lower-cased value; null, blank, NA, N/A, null and None values have none; a token never spans
    two values. Repeated rows count each time. Every row, whole values, nothing capped. Empty table: no rows.

    Suffix-sorted counting: each task folds the suffixes, truncated to sigma tokens, of its rows into a hash table bounded by
    TABLE_ENTRIES and spills mergeable states; equal suffixes merge again map-side; suffixes are routed by their first term, sorted in
    descending order, and one stack per task adds up all prefixes. A hot first term is split by its second token into `salt` routes (as many as
    shuffle partitions, if not given);
    what a route has of a shorter prefix is a partial count, and a last aggregation by term adds the few partial counts up."""
    spark = df.sparkSession
    states = df.select(*fields).mapInArrow(
        _suffixes(fields, sigma), "field string, suffix string, cf bigint, " + ", ".join(f"d{i} bigint" for i in range(1, sigma + 1))
    )
    sums = [F.sum("cf").alias("cf"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(1, sigma + 1)]]
    merged = states.groupBy("field", "suffix").agg(*sums)
    first = F.substring_index("suffix", " ", 1)
    second = F.substring_index(F.substring_index("suffix", " ", 2), " ", -1)
    salt = salt or default_parallelism(spark)
    routed = merged.repartition(default_parallelism(spark), F.col("field"), first, F.pmod(F.xxhash64(second), F.lit(salt)))
    # token-wise order: a space sorts before all token characters
    ordered = routed.sortWithinPartitions(F.desc("field"), F.desc("suffix"))
    parts = ordered.mapInArrow(_stack(sigma), "field string, term string, n int, cf bigint, df bigint")
    return parts.groupBy("field", "term").agg(F.first("n").cast("long").alias("n"), F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def marked(counts: DataFrame, rows: DataFrame, common: float = 0.01) -> DataFrame:
    """Adds mark: too_rare for terms in exactly one row, too_common for those in more than `common` of all rows, null for the rest.
    A table of one row makes its terms too_rare."""
    total = rows.agg(F.count(F.lit(1)).alias("_rows"))
    mark = F.when(F.col("df") == 1, "too_rare").when(F.col("df") > F.lit(common) * F.col("_rows"), "too_common")
    return counts.join(F.broadcast(total)).withColumn("mark", mark).drop("_rows")
