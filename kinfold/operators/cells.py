"""Pairs that share tokens, looked at where references and all targets of their country meet, instead of being moved and written as pairs.

The references of a country are cut into groups, its targets into chunks that a task can hold (mostly one). A cell indexes its targets
by token once and finds, scores and ranks the pairs of some references at a time in numpy; only what a reference keeps leaves the cell."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrow import uncollected
from ..sources.scratch import default_parallelism, materialize
from . import hot
from .entities import tokens

#: References of a cell; targets of a cell that reads their whole texts, and of one that reads tokens only.
CELL_REFERENCES, CELL_TARGETS, CELL_POSTINGS = 50_000, 600_000, 2_000_000
#: Targets of a cell that passes on every pair worth a model: less of them where the cells would be too few for the cluster.
LEAST_PASSING, MOST_PASSING = 10_000, 50_000
#: Hits of tokens and references that are looked at at once, and rows that leave a cell at once.
HITS_AT_ONCE, REFERENCES_AT_ONCE, ROWS_AT_ONCE = 500_000, 500, 50_000
TOKENS = "array<struct<token:string,w:double>>"


def spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The positions first, first + 1, ... of n items each, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)


class Index:
    """Words of both fields of a cell's targets as numbers, by target and by word. A word of the address is one by itself; words are in
    order, those of the name first, and none that no reference has is kept."""

    def __init__(self, targets: pa.Table, vocabulary: pa.Array):
        self.words, self.base, n = vocabulary, len(vocabulary), targets.num_rows
        keys, at = [], 0
        for b in targets.select(["name_norm", "address_norm"]).to_batches(max_chunksize=100_000):
            for f in (0, 1):
                words = pc.split_pattern(b.column(f), " ")
                code = pc.index_in(words.flatten(), value_set=vocabulary).fill_null(-1).to_numpy()
                row = np.repeat(np.arange(at, at + b.num_rows), pc.list_value_length(words).to_numpy())
                keys.append((row * (2 * self.base) + code + f * self.base)[code >= 0])
            at += b.num_rows
        keys = np.unique(np.concatenate(keys)) if keys else np.empty(0, dtype=np.int64)
        row, self.word = keys // max(1, 2 * self.base), (keys % max(1, 2 * self.base)).astype(np.int32)
        self.n_words = np.bincount(row, minlength=n)
        self.first_word = np.cumsum(self.n_words) - self.n_words
        self.target = row[np.argsort(self.word, kind="stable")].astype(np.int32)
        self.n_targets = np.bincount(self.word, minlength=2 * self.base)
        self.first_target = np.cumsum(self.n_targets) - self.n_targets

    def met(self, ref: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the given, target) of all targets that have the word."""
        n = self.n_targets[word]
        return np.repeat(np.arange(len(ref)), n), self.target[spans(self.first_target[word], n)]


class Lists:
    """A column of token lists of references, as (reference, word, weight) in order; words that no target can have are left out."""

    def __init__(self, columns: list[pa.ListArray], vocabulary: pa.Array):
        refs, words, weights = [], [], []
        for f, c in enumerate(columns):
            flat, n = c.flatten(), pc.list_value_length(c).fill_null(0).to_numpy()
            code = pc.index_in(flat.field("token"), value_set=vocabulary).fill_null(-1).to_numpy()
            some = code >= 0
            refs.append(np.repeat(np.arange(len(c)), n)[some])
            words.append(code[some].astype(np.int64) + f * len(vocabulary))
            weights.append(flat.field("w").to_numpy(zero_copy_only=False)[some])
        order = np.lexsort((np.concatenate(words), np.concatenate(refs)))
        self.ref, self.word, self.weight = (np.concatenate(x)[order] for x in (refs, words, weights))

    def of(self, low: int, high: int) -> slice:
        return slice(*np.searchsorted(self.ref, [low, high]))


def _groups(hits: np.ndarray) -> list[tuple[int, int]]:
    """Runs of at most REFERENCES_AT_ONCE references with about HITS_AT_ONCE hits."""
    if not len(hits):
        return []
    ends = np.flatnonzero(np.diff(np.cumsum(hits + HITS_AT_ONCE // REFERENCES_AT_ONCE) // HITS_AT_ONCE, append=-1)) + 1
    return list(zip([0, *ends[:-1].tolist()], ends.tolist()))


def _best(ref: np.ndarray, by: np.ndarray, k: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k best of each reference, and their ranks from 0; ties by position. ref is in order."""
    order = np.lexsort((-by, ref))
    rank = np.arange(len(ref)) - np.searchsorted(ref, ref)
    top = rank < (k[ref] if isinstance(k, np.ndarray) else k)
    return order[top], rank[top]


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _split(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table] | None:
    rows = pa.Table.from_batches(list(batches))
    mine = pc.is_valid(rows.column("_own"))
    refs, tgs = rows.filter(mine), rows.select(["entity_id", "name_norm", "address_norm"]).filter(pc.invert(mine))
    if not refs.num_rows or not tgs.num_rows:
        return None
    own = _column(refs, "_own")
    for i, f in enumerate(own.type):
        refs = refs.append_column(f.name, own.field(i))
    return refs, tgs.sort_by("entity_id")


def _vocabulary(lists: list[pa.ListArray]) -> pa.Array:
    words = pc.unique(pa.concat_arrays([c.flatten().field("token") for c in lists]))
    return words.take(pc.sort_indices(words))


def _passed(columns: dict[str, pa.Array | np.ndarray]) -> Iterator[pa.RecordBatch]:
    b = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
    yield from (b.slice(i, ROWS_AT_ONCE) for i in range(0, b.num_rows, ROWS_AT_ONCE))


def _ranked(k: int, counted: bool):
    """The k best targets of each reference by the sum of the weights of shared tokens, or by these and the numbers of tokens."""

    @uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (both := _split(batches)) is None:
            return
        refs, tgs = both
        del both
        lists = [_column(refs, c) for c in ("wn", "wa")]
        vocabulary = _vocabulary(lists)
        own, index = Lists(lists, vocabulary), Index(tgs, vocabulary)
        s, t, n = _column(refs, "entity_id"), _column(tgs, "entity_id"), tgs.num_rows
        del tgs
        for low, high in _groups(np.bincount(own.ref, index.n_targets[own.word], refs.num_rows).astype(np.int64)):
            x = own.of(low, high)
            at, target = index.met(own.ref[x], own.word[x])
            pairs, pair = np.unique(own.ref[x][at] * n + target, return_inverse=True)
            weight, address = own.weight[x][at], own.word[x][at] >= index.base
            if counted:
                total = lambda of, w=None: np.bincount(pair[of], w if w is None else w[of], len(pairs))
                score = total(address) * 12.0 + total(~address) * 9.0 + total(address, weight) + total(~address, weight) * 0.8
            else:
                score = np.bincount(pair, np.where(address, 1.0, 1.5) * weight, len(pairs))
            ref, score = pairs // n, hot.half_up(score)
            best, rank = _best(ref, score, k)
            yield from _passed({"s": s.take(pa.array(ref[best])), "t": t.take(pa.array(pairs[best] % n)), "score": score[best], "rank": rank + 1})

    return run


class Pairs:
    """Pairs (reference, target) of a cell, with the tokens they share."""

    def __init__(self, pairs: np.ndarray, n: int, own: Lists, x: slice, low: int, high: int, index: Index):
        self.ref, self.t = pairs // n, pairs % n
        short = np.full(2 * index.base, -1, dtype=np.int32)  # the words of these references, numbered anew
        words, number = np.unique(own.word[x], return_inverse=True)
        short[words] = np.arange(len(words))
        weight = np.full((high - low, len(words)), np.nan)
        weight[own.ref[x] - low, number] = own.weight[x]
        m = index.n_words[self.t]
        word, pair = index.word[spans(index.first_word[self.t], m)], np.repeat(np.arange(len(pairs)), m)
        known = short[word]
        some = known >= 0
        pair, word = pair[some], word[some]
        w = weight[self.ref[pair] - low, known[some]]
        hit = ~np.isnan(w)
        self.pair, self.word, self.weight, self.base, self.n = pair[hit], word[hit], w[hit], index.base, len(pairs)

    def field(self, f: int) -> np.ndarray:
        return (self.word >= self.base) == bool(f)

    def shared(self, f: int, long: np.ndarray) -> np.ndarray:
        return np.bincount(self.pair[self.field(f) & long[self.word % self.base]], minlength=self.n)

    def weighed(self, f: int, each: float) -> np.ndarray:
        """Sums in the order of the reference's tokens, as in scoring.Field."""
        at = self.field(f)
        w = self.weight[at]
        return np.bincount(np.repeat(self.pair[at], 2), np.column_stack((w, np.full(len(w), each))).ravel(), minlength=self.n)


class Values:
    """Equal texts of one field on both sides: their numbers, and the targets that have each."""

    def __init__(self, mine: pa.Array, theirs: pa.Array):
        both = pa.concat_arrays([mine, theirs]).dictionary_encode()
        at = both.indices.to_numpy()
        self.mine, self.theirs, texts = at[: len(mine)], at[len(mine) :], both.dictionary
        self.order = np.argsort(self.theirs, kind="stable")
        self.n = np.bincount(self.theirs, minlength=len(texts))
        self.first = np.cumsum(self.n) - self.n
        self.mask, self.length = hot.masks(texts), pc.utf8_length(texts).to_numpy().astype(np.int64)
        self.some = self.length > 0
        words = pc.split_pattern(texts, " ")
        coded, row = words.flatten().dictionary_encode(), np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
        n = max(1, len(coded.dictionary))
        keys = np.unique(row * n + coded.indices.to_numpy())
        long = pc.utf8_length(coded.dictionary).to_numpy() >= 3
        self.size = np.bincount((keys // n)[long[keys % n]], minlength=len(texts))


def _stage1(cap: int, k: int, bonus: float, exact: bool):
    """Of each reference the k pairs that stage 1 ranks first (kind 1), if all its targets are here or the cap can't reach it. Else, of its
    protected pairs the same and their number (kind 2, in lexical), and of the others the best by lexical score up to the cap (kind 0)."""

    @uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (both := _split(batches)) is None:
            return
        refs, tgs = both
        del both
        lists = [_column(refs, c) for c in ("wn", "wa")]
        vocabulary = _vocabulary(lists)
        own, rare, index = Lists(lists, vocabulary), Lists([_column(refs, c) for c in ("kn", "ka")], vocabulary), Index(tgs, vocabulary)
        s, t, n = _column(refs, "entity_id"), _column(tgs, "entity_id"), tgs.num_rows
        values = [Values(_column(refs, c), _column(tgs, c)) for c in ("name_norm", "address_norm")]
        blocks = [_column(refs, c).to_numpy(zero_copy_only=False) & v.some[v.mine] for c, v in zip(("xn", "xa"), values)]
        apart = _column(refs, "_apart").to_numpy(zero_copy_only=False)
        del tgs
        long = pc.utf8_length(vocabulary).to_numpy() >= 3
        hits = np.bincount(rare.ref, index.n_targets[rare.word], refs.num_rows).astype(np.int64)
        for b, v in zip(blocks, values):
            hits += np.where(b, v.n[v.mine], 0)
        for low, high in _groups(hits):
            x = rare.of(low, high)
            at, target = index.met(rare.ref[x], rare.word[x])
            found = [rare.ref[x][at] * n + target]
            for b, v in zip(blocks, values):
                r = np.flatnonzero(b[low:high]) + low
                m = v.n[v.mine[r]]
                found.append(np.repeat(r, m) * n + v.order[spans(v.first[v.mine[r]], m)])
            pairs = np.unique(np.concatenate(found))
            p = Pairs(pairs, n, own, own.of(low, high), low, high, index)
            ref, total = p.ref, np.zeros(len(pairs))
            same = [(v.mine[ref] == v.theirs[p.t]) & v.some[v.mine[ref]] for v in values]
            protected = np.logical_or(*same) if exact else np.zeros(len(pairs), dtype=bool)
            n_all, n_kept = (np.bincount(ref[a], minlength=high)[low:high] for a in (slice(None), protected))
            cut = apart[low:high] | (n_all > cap)  # references that the cap may reach
            free = np.ones(len(pairs), dtype=bool)
            if cut.any():
                lexical = hot.half_up(same[0] * bonus + same[1] * bonus + p.weighed(0, 100.0) + p.weighed(1, 150.0))
                rest = np.flatnonzero(~protected & cut[ref - low])
                room = np.where(apart[low:high], cap, np.maximum(0, cap - n_kept))
                best = rest[_best(ref[rest] - low, lexical[rest], room)[0]]
                free[rest] = False
                free[best] = ~apart[ref[best]]
            shared, overlap, alike = [], [], []
            for f, v in enumerate(values):
                i, j = v.mine[ref], v.theirs[p.t]
                shared.append(p.shared(f, long))
                overlap.append(shared[f] / np.maximum(1, np.minimum(v.size[i], v.size[j])))
                union = np.bitwise_count(v.mask[i] | v.mask[j]).astype(np.int64)
                alike.append(np.where(union == 0, 0.0, np.bitwise_count(v.mask[i] & v.mask[j]) / np.maximum(union, 1)))
            total = (same[0] * 100.0 + same[1] * 100.0 + overlap[0] * 30.0 + overlap[1] * 40.0 + np.minimum(shared[0], 5) * 8.0
                     + np.minimum(shared[1], 5) * 10.0 + alike[0] * 5.0 + alike[1] * 5.0)
            score = hot.half_up(total)
            worth = same[0] | same[1] | (shared[0] >= 2) | (shared[1] >= 2) | (score >= 30)
            top = np.flatnonzero(free & worth)
            top = top[_best(ref[top], score[top], k)[0]]
            out = [(ref[top], p.t[top], score[top], np.ones(len(top), dtype=np.int64), np.zeros(len(top)))]
            if cut.any() and (far := best[apart[ref[best]]]).size:
                out.append((ref[far], p.t[far], np.where(worth[far], score[far], np.nan), np.zeros(len(far), dtype=np.int64), lexical[far]))
            if (lone := np.flatnonzero(apart[low:high] & (n_kept > 0))).size:
                none = np.zeros(len(lone), dtype=np.int64)
                out.append((lone + low, none, none + np.nan, none + 2, n_kept[lone].astype(float)))
            r, tt, sc, kind, lx = (np.concatenate(c) for c in zip(*out))
            yield from _passed({"s": s.take(pa.array(r)), "t": t.take(pa.array(tt)), "score": sc, "kind": kind, "lexical": lx})

    return run


def _lexical(cap: int, bonus: float):
    """The best targets of each reference by lexical score, up to the cap."""

    @uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (both := _split(batches)) is None:
            return
        refs, tgs = both
        del both
        lists = [_column(refs, c) for c in ("wn", "wa")]
        vocabulary = _vocabulary(lists)
        own, rare, index = Lists(lists, vocabulary), Lists([_column(refs, c) for c in ("kn", "ka")], vocabulary), Index(tgs, vocabulary)
        s, t, n = _column(refs, "entity_id"), _column(tgs, "entity_id"), tgs.num_rows
        equal = []
        for c in ("name_norm", "address_norm"):
            mine = _column(refs, c)
            equal.append((np.where(pc.utf8_length(mine).to_numpy() > 0, np.arange(len(mine)), -1), *_numbers(mine, _column(tgs, c))))
        del tgs
        for low, high in _groups(np.bincount(rare.ref, index.n_targets[rare.word], refs.num_rows).astype(np.int64)):
            x = rare.of(low, high)
            at, target = index.met(rare.ref[x], rare.word[x])
            p = Pairs(np.unique(rare.ref[x][at] * n + target), n, own, own.of(low, high), low, high, index)
            same = [(some[p.ref] >= 0) & (mine[p.ref] == theirs[p.t]) for some, mine, theirs in equal]
            score = hot.half_up(same[0] * bonus + same[1] * bonus + p.weighed(0, 100.0) + p.weighed(1, 150.0))
            best, _ = _best(p.ref, score, cap)
            yield from _passed({"s": s.take(pa.array(p.ref[best])), "t": t.take(pa.array(p.t[best])), "score": score[best]})

    return run


class Judged:
    """References and targets of a cell, all pairs of which are judged by the keep rule of stage 1 (scoring.KEEP)."""

    def __init__(self, refs: pa.Table, tgs: pa.Table):
        both = [(_column(refs, c), _column(tgs, c)) for c in ("name_norm", "address_norm")]
        words = pc.unique(pa.concat_arrays([pc.split_pattern(mine, " ").flatten() for mine, _ in both]))
        vocabulary = words.filter(pc.greater_equal(pc.utf8_length(words), 3))
        self.own, self.index, self.n = Index(refs, vocabulary), Index(tgs, vocabulary), tgs.num_rows
        self.values = [Values(*x) for x in both]
        self.size, self.mask = ([getattr(v, a)[v.theirs] for v in self.values] for a in ("size", "mask"))

    def kept(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """(targets worth a model, tokens of name and address shared with each). Without a shared token or an equal field no score reaches 30."""
        shared, index, own = np.zeros((2, self.n), dtype=np.int32), self.index, self.own
        for w in own.word[own.first_word[r] :][: own.n_words[r]]:
            shared[int(w >= index.base)][index.target[index.first_target[w] :][: index.n_targets[w]]] += 1
        most = np.maximum(*shared)
        sure = most >= 2
        for v in self.values:
            if v.some[code := v.mine[r]]:
                sure[v.order[v.first[code] :][: v.n[code]]] = True
        one = np.flatnonzero((most == 1) & ~sure)
        overlap, alike = [], []
        for f, v in enumerate(self.values):
            code = v.mine[r]
            overlap.append(shared[f][one] / np.maximum(1, np.minimum(v.size[code], self.size[f][one])))
            union = np.bitwise_count(self.mask[f][one] | v.mask[code])
            alike.append(np.bitwise_count(self.mask[f][one] & v.mask[code]) / np.maximum(1, union))
        x = overlap[0] * 30.0 + overlap[1] * 40.0 + shared[0][one] * 8.0 + shared[1][one] * 10.0 + alike[0] * 5.0 + alike[1] * 5.0
        at = np.concatenate([np.flatnonzero(sure), one[hot.half_up(x) >= 30]])
        return at, shared[:, at]

    def features(self, ref: np.ndarray, t: np.ndarray, shared: np.ndarray) -> dict[str, np.ndarray]:
        """Those of scoring.features in serving mode, but for the target's source."""
        out = {"country_match": np.ones(len(ref), dtype=np.int64)}
        for f, v, n in zip(("name", "address"), self.values, shared.astype(np.int64)):
            i, j = v.mine[ref], v.theirs[t]
            size, length = ([a[i], a[j]] for a in (v.size, v.length))
            both, any_ = np.bitwise_count(v.mask[i] & v.mask[j]), np.bitwise_count(v.mask[i] | v.mask[j])
            least, most = np.minimum(*length), np.maximum(*length)
            out |= {
                f"{f}_exact": ((i == j) & v.some[i]).astype(np.int64),
                f"{f}_jaccard": hot.half_up(n / np.maximum(1, size[0] + size[1] - n), 6),
                f"{f}_overlap": hot.half_up(n / np.maximum(1, np.minimum(*size)), 6),
                f"{f}_shared_tokens": n,
                f"{f}_char_similarity": hot.half_up(both / np.maximum(1, any_), 6),
                f"{f}_length_diff": most - least,
                f"{f}_length_ratio": hot.half_up(least / np.maximum(1, most), 6),
            }
        return out


def _features(names: list[str]):
    """Every pair worth a model, with its features."""

    @uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (both := _split(batches)) is None:
            return
        refs, tgs = both
        del both
        cell, s, t = Judged(refs, tgs), _column(refs, "entity_id"), _column(tgs, "entity_id")
        source = {f"target_is_s{i}": pc.starts_with(t, f"S{i}").cast(pa.int64()).to_numpy() for i in (2, 3)}
        del refs, tgs
        found, n = [], 0
        for r in range(len(s)):
            at, shared = cell.kept(r)
            found.append((np.full(len(at), r), at, shared))
            n += len(at)
            if n < ROWS_AT_ONCE and r < len(s) - 1:
                continue
            ref, target, both = (np.concatenate(c, axis=-1) for c in zip(*found))
            for x in (slice(i, i + ROWS_AT_ONCE) for i in range(0, n, ROWS_AT_ONCE)):
                has = cell.features(ref[x], target[x], both[:, x]) | {c: a[target[x]] for c, a in source.items()}
                yield from _passed({"s": s.take(pa.array(ref[x])), "t": t.take(pa.array(target[x]))} | {c: has[c] for c in names})
            found, n = [], 0

    return run


def _numbers(mine: pa.Array, theirs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of equal texts on both sides; -1 for those of the other side that are on none of this."""
    known = pc.unique(mine)
    return (pc.index_in(a, value_set=known).fill_null(-1).to_numpy() for a in (mine, theirs))


def several(df: DataFrame) -> DataFrame | None:
    """(entity_id) of ids with several rows; None if there are none."""
    ids = materialize(df.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("entity_id"), "several")
    return ids if ids.head() else None


def crowded(tg: DataFrame, most: int) -> list[str]:
    """The countries with more than `most` targets."""
    return [r[0] for r in tg.where("country is not null").groupBy("country").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).collect()]


def _met(refs: DataFrame, tg: DataFrame, run, schema: str, most: int) -> DataFrame:
    """Rows that `run` makes of the cells of each country. Ids are there once on either side."""
    size = lambda d, n: d.where("country is not null").groupBy("country").agg(F.ceil(F.count(F.lit(1)) / F.lit(n)).cast("int").alias("n"))
    ns, nt = (size(d, n).select(F.col("country").alias("_c"), F.col("n").alias(c)) for d, n, c in ((refs, CELL_REFERENCES, "_ni"), (tg, most, "_nj")))
    cells = materialize(ns.join(nt, "_c"), "cells")
    several, n = cells.where("_ni > 1 or _nj > 1"), cells.agg(F.sum(F.col("_ni").cast("long") * F.col("_nj"))).head()[0] or 1
    own_only = F.struct(*[c for c in refs.columns if c not in ("entity_id", "name_norm", "address_norm", "country")])
    of = refs.select(own_only.alias("_own")).dtypes[0][1]

    def side(d: DataFrame, target: bool) -> DataFrame:
        d = d.where("country is not null").join(F.broadcast(several), d["country"] == several["_c"], "left")
        mine, theirs = (F.coalesce(c, F.lit(1)) for c in (("_nj", "_ni") if target else ("_ni", "_nj")))
        own, every = F.pmod(F.xxhash64("entity_id"), mine).cast("int"), F.explode(F.sequence(F.lit(0), theirs - 1))
        i, j = (every, own) if target else (own, every)
        more = (F.lit(None).cast(of) if target else own_only).alias("_own")
        return d.select("entity_id", "name_norm", "address_norm", "country", more, i.alias("_i"), j.alias("_j"))

    both = side(refs, False).unionByName(side(tg, True))
    both = both.repartition(max(default_parallelism(refs.sparkSession), min(2_000, 3 * n)), "country", "_i", "_j")
    return both.groupBy("country", "_i", "_j").applyInArrow(run, schema)


def weighted(s1: DataFrame, df: DataFrame, kind, cutoff: int, k_name: int, k_address: int) -> DataFrame:
    """References with the weights 10000/df of their tokens (wn, wa) and their rarest tokens with df <= cutoff (kn, ka); ties by token.
    Those of which no target has any token are left out."""
    all_ = tokens(s1, kind).join(df, ["field", "token"]).groupBy("entity_id").agg(F.collect_list(F.struct("field", "df", "token")).alias("_all"))
    weight = lambda a: F.transform(a, lambda x: F.struct(x["token"].alias("token"), (F.lit(10_000.0) / x["df"]).alias("w")))
    of = lambda f: F.filter("_all", lambda x: x["field"] == f)
    rare = lambda f, k: F.slice(F.array_sort(F.filter("_all", lambda x: (x["field"] == f) & (x["df"] <= cutoff))), 1, k)
    out = all_.select(
        "entity_id", weight(of("name")).alias("wn"), weight(of("address")).alias("wa"), weight(rare("name", k_name)).alias("kn"), weight(rare("address", k_address)).alias("ka"),
        F.aggregate(F.concat(rare("name", k_name), rare("address", k_address)), F.lit(0).cast("long"), lambda n, x: n + x["df"]).alias("_hits"),
    )
    return s1.select("entity_id", "name_norm", "address_norm", "country").join(out, "entity_id")


def stage1(s1: DataFrame, tg: DataFrame, cfg, df: DataFrame, large: DataFrame | None, kind) -> DataFrame:
    """(s, t, score): of each reference at least the pairs outside of large blocks that stage 1 ranks first, after the cap."""
    refs = weighted(s1, df, kind, cfg.max_token_freq, cfg.k_name, cfg.k_address)
    some = lambda f: F.col(f"{f}_norm") != ""
    if large is not None:
        refs = refs.join(hot.members(s1, large).select("entity_id", F.col("_blocks._key").alias("_large")), "entity_id", "left")
        none = F.array().cast(TOKENS)
        refs = refs.withColumns({c: F.when(F.col("_large").isNull(), F.col(c)).otherwise(none) for c in ("kn", "ka")})
        inside = lambda f: F.coalesce(F.array_contains("_large", F.concat_ws("\u0001", F.lit(f), "country", f"{f}_norm")), F.lit(False))
    else:
        inside = lambda f: F.lit(False)
    refs = refs.withColumns({x: F.lit(cfg.exact_blocks) & some(f) & ~inside(f) for x, f in (("xn", "name"), ("xa", "address"))})
    many, apart = crowded(tg, CELL_TARGETS), F.lit(False)
    if many:  # an exact block lies within the hits of a rare token of its field; without one its targets are counted
        far = F.col("country").isin(many)
        for f, k, x in (("name", "kn", "xn"), ("address", "ka", "xa")):
            key = F.xxhash64(F.lit(f), "country", f"{f}_norm").alias(f"_{x}")
            n = tg.where(far & some(f)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            refs = refs.withColumn(f"_{x}", F.when(far & F.col(x) & (F.size(k) == 0), key)).join(n, f"_{x}", "left")
            refs = refs.withColumn("_hits", F.col("_hits") + F.coalesce("_n", F.lit(0))).drop(f"_{x}", "_n")
        apart = far & (F.size("kn") + F.size("ka") > 0) & (F.col("_hits") > cfg.cap)
    refs = refs.withColumn("_apart", F.coalesce(apart, F.lit(False))).drop("_hits", "_large")
    refs = materialize(refs, "weighted")
    schema = "s string, t string, score double, kind bigint, lexical double"
    out = materialize(_met(refs, tg, _stage1(cfg.cap, cfg.top_k, cfg.exact_bonus, cfg.exact_blocks), schema, CELL_TARGETS), "cells")
    if not many:
        return out.select("s", "t", "score")
    n = out.where("kind = 2").groupBy("s").agg(F.sum("lexical").alias("_np"))
    w = Window.partitionBy("s").orderBy(F.desc("lexical"), "t")
    rest = out.where("kind = 0").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cfg.cap).join(n, "s", "left")
    rest = rest.where((F.col("_rn") <= F.lit(cfg.cap) - F.coalesce("_np", F.lit(0))) & ~F.isnan("score"))
    return out.where("kind = 1").select("s", "t", "score").unionByName(rest.select("s", "t", "score"))


def _merged(refs: DataFrame, tg: DataFrame, run, schema: str, top) -> DataFrame:
    """Lists that cells end; those of countries with several chunks of targets are merged by `top`."""
    many = crowded(tg, CELL_POSTINGS)
    if not many:
        return _met(refs, tg, run, schema, CELL_POSTINGS)
    far = F.col("country").isin(many)
    ends = lambda x: (refs.where(x), tg.where(x))
    return _met(*ends(~far), run, schema, CELL_POSTINGS).unionByName(top(_met(*ends(far), run, schema, CELL_POSTINGS)))


def lexical(s1: DataFrame, tg: DataFrame, cfg, df: DataFrame, kind, top) -> DataFrame:
    """(s, t, score): of each reference the best pairs that share a rare token, up to the cap."""
    refs = materialize(weighted(s1, df, kind, cfg.max_token_freq, cfg.k_name, cfg.k_address).drop("_hits"), "weighted")
    return _merged(refs, tg, _lexical(cfg.cap, cfg.exact_bonus), "s string, t string, score double", top)


def ranked(s1: DataFrame, tg: DataFrame, known: DataFrame, kind, k: int, counted: bool, top) -> DataFrame:
    """(s, t, score, rank): the k best pairs of each reference by their shared tokens among `known` (country, token, idf)."""
    own = tokens(s1, kind).join(known, ["country", "token"]).groupBy("entity_id", "country")
    of = lambda f: F.collect_list(F.when(F.col("field") == f, F.struct("token", F.col("idf").alias("w"))))
    refs = own.agg(of("name").alias("wn"), of("address").alias("wa")).withColumns({"name_norm": F.lit(""), "address_norm": F.lit("")})
    return _merged(materialize(refs, "weighted"), tg, _ranked(k, counted), "s string, t string, score double, rank bigint", top)


def features(s1: DataFrame, tg: DataFrame, names: list[str]) -> DataFrame:
    """(s, t, features): every pair of a country that is worth a model. All pairs of a cell are looked at, and none is moved or written.
    No cell has to know of another, so targets are moved once, and references, which are fewer, to each chunk of these."""
    most = min(MOST_PASSING, max(LEAST_PASSING, tg.count() // (2 * default_parallelism(s1.sparkSession))))
    kind = lambda c: "double" if c.endswith(("jaccard", "overlap", "similarity", "ratio")) else "bigint"
    schema = "s string, t string, " + ", ".join(f"{c} {kind(c)}" for c in names)
    return _met(s1.withColumn("_mine", F.lit(True)), tg, _features(names), schema, most)
