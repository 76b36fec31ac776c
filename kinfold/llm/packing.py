"""Filling containers of fixed capacity with items of varying size."""
from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: Items, or underfull bins and the items in them, that one task packs.
ITEMS_PER_GROUP, PARTS_PER_GROUP = 20_000, 400_000
#: A round that leaves more than this share of its items as underfull bins has shown that they don't go together; the next is the last.
STUCK = 0.9
#: A bin with at most this share of its capacity left is emitted as nearly full.
NEARLY_FULL = 0.004

ITEM = "array<struct<doc_id:bigint,piece:int,n_tokens:bigint>>"


def best_fit(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit over decreasing sizes, each at most capacity: [(room left, indices of sizes)]. Ties keep the order given."""
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    left: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        at = bisect_left(rooms, (s, -1))
        if at < len(rooms):
            _, b = rooms.pop(at)
        else:
            b = len(bins)
            bins.append([])
            left.append(capacity)
        bins[b].append(i)
        left[b] -= s
        insort(rooms, (left[b], b))
    return list(zip(left, bins))


def _round(last: frozenset):
    """One group: pack, emit what is nearly full, pass on the other bins (none in the last round of a container)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        container, group = key[0].as_py(), key[1].as_py()
        capacity = table.column("capacity")[0].as_py()
        order = sorted(range(table.num_rows), key=lambda i: (table.column("tie")[i].as_py()))
        sizes_all, parts_all = table.column("size").to_pylist(), table.column("parts").to_pylist()
        sizes = [sizes_all[i] for i in order]
        parts = [parts_all[i] for i in order]
        packed = best_fit(sizes, capacity)
        packed.sort(key=lambda x: -x[0])
        out: dict[str, list] = {k: [] for k in ("container", "capacity", "grp", "tie", "size", "parts", "done")}
        for room, members in packed:
            inside = [p for m in members for p in parts[m]]
            done = container in last or room <= capacity * NEARLY_FULL
            out["container"].append(container)
            out["capacity"].append(capacity)
            out["grp"].append(group)
            out["tie"].append(min((p["doc_id"], p["piece"]) for p in inside)[0] if inside else 0)
            out["size"].append(capacity - room)
            out["parts"].append(inside)
            out["done"].append(done)
        return pa.table(
            [
                pa.array(out["container"], pa.string()), pa.array(out["capacity"], pa.int64()), pa.array(out["grp"], pa.int64()),
                pa.array(out["tie"], pa.int64()), pa.array(out["size"], pa.int64()),
                pa.array(out["parts"], pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int64())]))),
                pa.array(out["done"], pa.bool_()),
            ],
            names=list(out),
        )

    return run


SCHEMA = f"container string, capacity bigint, grp bigint, tie bigint, size bigint, parts {ITEM}, done boolean"


def pack(sizes: DataFrame, containers: DataFrame) -> DataFrame:
    """(container, capacity, bin, doc_id, piece, n_tokens): every item of sizes(doc_id, n_tokens) in a bin of each container kind.

    Only an item larger than the capacity is split: into pieces of exactly the capacity, numbered from 0, and one last smaller piece.
    A null size counts as 0; an item of size 0 is placed too. A null or non-positive capacity gives no rows. Equal sizes are ordered by
    doc_id, so the result is the same on every run. An empty table: no rows. An id
    that occurs several times is one item, of its largest size; a row without an id is none.

    Pieces that fill a bin alone are emitted at once. The rest is spread over groups of about ITEMS_PER_GROUP items, each packed by best
    fit. Bins with at most NEARLY_FULL of room are emitted; the others become items of the next round, for which groups merge until each
    has about ITEMS_PER_GROUP bins (or PARTS_PER_GROUP items in them) again, until one group is left. No bin is emitted underfull before:
    where bins stay as many as they were (items of more than half a container, say), groups aren't merged further, as more of the same
    would not fit either, and a last round regroups and emits them. A task's input is bounded in any case, and every item comes out once."""
    c = containers.where("capacity > 0").select("container", F.col("capacity").cast("long").alias("capacity")).distinct()
    items = sizes.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
    items = materialize(items.where("doc_id is not null").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens")), "sizes")
    # container kinds are a dimension: the join replicates items once per kind
    pieces = items.join(F.broadcast(c)).withColumn("whole", F.floor(F.col("n_tokens") / F.col("capacity")).cast("int"))
    full = pieces.where("whole > 0").select(
        "container", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("piece"), F.col("capacity").alias("n_tokens")
    )
    full = full.select(
        "container", "capacity", F.concat_ws("-", F.lit("f"), "doc_id", "piece").alias("bin"), "doc_id", F.col("piece").cast("int").alias("piece"), "n_tokens"
    )
    rest = pieces.withColumn("n", F.col("n_tokens") - F.col("whole") * F.col("capacity")).where("n > 0 or n_tokens = 0")
    level = rest.select(
        "container", "capacity", F.col("doc_id").alias("tie"), F.col("n").alias("size"), F.xxhash64("doc_id").alias("grp"),
        F.array(F.struct("doc_id", F.col("whole").alias("piece"), F.col("n").alias("n_tokens"))).alias("parts"),
    )
    done: list[DataFrame] = []
    counted = {r["container"]: (r["k"], r["p"]) for r in rest.groupBy("container").agg(F.count(F.lit(1)).alias("k"), F.count(F.lit(1)).alias("p")).collect()}
    before: dict[str, int] = {}
    while counted:
        groups = {c: max(1, -(-k // ITEMS_PER_GROUP), -(-p // PARTS_PER_GROUP)) for c, (k, p) in counted.items()}
        last = frozenset(c for c, (k, _) in counted.items() if groups[c] == 1 or k > STUCK * before.get(c, k * 2))
        of = F.create_map(*[x for c, g in groups.items() for x in (F.lit(c), F.lit(g).cast("long"))])
        level = level.withColumn("grp", F.pmod("grp", F.element_at(of, F.col("container"))))
        out = materialize(level.groupBy("container", "grp").applyInArrow(_round(last), SCHEMA), f"pack{len(done)}")
        done.append(out.where("done").withColumn("round", F.lit(len(done))))
        level = out.where("not done").select("container", "capacity", "tie", "size", "grp", "parts")
        before = {c: k for c, (k, _) in counted.items()}
        left = level.groupBy("container").agg(F.count(F.lit(1)).alias("k"), F.sum(F.size("parts")).alias("p")).collect()
        counted = {r["container"]: (r["k"], r["p"]) for r in left}
    if not done:
        return full
    bins = done[0]
    for d in done[1:]:
        bins = bins.unionByName(d)
    packed = bins.select(
        "container", "capacity",
        F.concat_ws("-", F.lit("b"), "round", "grp", F.element_at("parts", 1)["doc_id"], F.element_at("parts", 1)["piece"]).alias("bin"),
        F.explode("parts").alias("p"),
    )
    return full.unionByName(packed.select("container", "capacity", "bin", "p.doc_id", "p.piece", "p.n_tokens"))


def bin_report(assigned: DataFrame) -> DataFrame:
    """(container, capacity, bins, used, unused, unused_share) of an assignment."""
    per = assigned.groupBy("container", "capacity").agg(F.countDistinct("bin").alias("bins"), F.sum("n_tokens").alias("used"))
    unused = F.col("bins") * F.col("capacity") - F.col("used")
    return per.select("*", unused.alias("unused"), F.round(unused / (F.col("bins") * F.col("capacity")), 6).alias("unused_share"))


def checked(assigned: DataFrame) -> DataFrame:
    """(container, n_docs, n_overfull, n_torn): documents placed, bins over their capacity, and documents split without need or into more
    pieces than needed. The last two are 0."""
    bins = assigned.groupBy("container", "bin").agg(F.sum("n_tokens").alias("n"), F.max("capacity").alias("capacity"))
    over = bins.groupBy("container").agg(F.sum(F.when(F.col("n") > F.col("capacity"), 1).otherwise(0)).alias("n_overfull"))
    docs = assigned.groupBy("container", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("k"), F.max("capacity").alias("capacity"))
    torn = F.col("k") != F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("capacity")))
    per = docs.groupBy("container").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.when(torn, 1).otherwise(0)).alias("n_torn"))
    return per.join(over, "container").select("container", "n_docs", "n_overfull", "n_torn")
