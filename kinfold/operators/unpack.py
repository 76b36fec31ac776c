"""One row per value of fields that pack several values with changing delimiters and quoting."""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ordinary characters: runs of letters and digits, and single marks of words (hyphen, point, at, apostrophe) between them.
WORD = r"[\p{L}\p{N}_]+(?:[-.@]+[\p{L}\p{N}_]+|(?<=\p{L})['’](?=\p{L})[\p{L}\p{N}_]+)*"
#: An id: a run with a hyphen and a digit. Ids end where the next one begins, whatever stands between.
LINKED = r"(?=[\p{L}\p{N}_.@]*-)(?=[\p{L}_.@-]*\p{N})" + WORD
MISSING = ("", "na", "n/a", "null", "none", "[]", "-")
#: Skeleton tables up to this many characters are broadcast; longer ones are joined through a shuffle.
BROADCAST_CHARS = 4_000_000

RULE = "array<struct<at:int,pre:string,seps:array<string>,post:string>>"
# Marks that separate values wherever they stand outside quotes, and marks that do where none of these is used.
STRONG, WEAK = set(",;|\t\n\r"), set("/\\•·")


def is_missing(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*MISSING)


def skeleton(c: Column) -> Column:
    """The delimiters of a packed field: ids masked as I, other runs of ordinary characters as a."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, LINKED, "\u0001"), WORD, "a"), "\u0001", "I")


Value = tuple[int, str, tuple[str, ...], str]


def splitting_rule(sk: str) -> list[Value]:
    """For a skeleton, each value: (first run from 0, text before it, texts between its runs, text behind the last).

    Brackets, and quotes round a whole list, are packing. A quoted span is one value, delimiters included; a doubled quote in it is a
    quote. Outside quotes the delimiters are the STRONG marks used in the skeleton; where it has none, the WEAK ones and wide gaps. An id
    and a word glued to it by one other mark are one value; two ids never are. Else spaces and other marks belong to the value."""
    s = sk.strip()
    while len(s) > 1 and (s[0], s[-1]) in (("[", "]"), ("{", "}"), ("(", ")")):
        s = s[1:-1].strip()
    if len(s) > 1 and s[0] == s[-1] and s[0] in "\"'":
        inner = s[1:-1]
        if s[0] * 2 in inner or (s[0] not in inner and inner.count("I") > 1):
            s = inner.replace(s[0] * 2, s[0])
    parts = _parts(s)
    strong = any(kind == "t" and not STRONG.isdisjoint(text) for kind, text, _ in parts)
    out: list[Value] = []
    open_: list | None = None  # first run, text before, texts between, kinds

    def close(post: str = "") -> None:
        nonlocal open_
        if open_:
            at, pre, seps, kinds = open_
            lone = kinds[0] == "I" and (len(kinds) == 1 or kinds == ["I", "a"])
            out.append((at, "" if lone else pre, tuple(seps), "" if lone else post))
        open_ = None

    run, gap = 0, ""
    for k, (kind, text, inside) in enumerate(parts):
        if kind == "t":
            gap = text
            continue
        if kind == "q":
            close(_edge(gap, strong, last=False))
            n, pre, seps, post = inside
            out.append((run, pre, tuple(seps), post))
            run, gap = run + n, ""
            continue
        behind = parts[k + 1][1][:1] if k + 1 < len(parts) else ""
        if open_ and _splits(gap, open_[3], kind, behind, strong):
            close(_edge(gap, strong, last=False))
        if open_:
            open_[2].append(gap)
            open_[3].append(kind)
        else:
            open_ = [run, _edge(gap, strong, last=True), [], [kind]]
        run, gap = run + 1, ""
    close(_edge(gap, strong, last=False))
    return out


def _parts(s: str) -> list[tuple]:
    """(kind, text, inside): runs I and a, texts t between them, and quoted spans q with (runs, before, between, behind)."""
    out: list[tuple] = []
    i, text = 0, ""
    while i < len(s):
        c = s[i]
        quoted = None
        if c in "\"'" and (i == 0 or s[i - 1] not in "Ia"):
            j = i + 1
            while j < len(s) and not (s[j] == c and s[j + 1 : j + 2] != c and s[j + 1 : j + 2] not in ("I", "a")):
                j += 2 if s[j] == c and s[j + 1 : j + 2] == c else 1
            if j < len(s):
                quoted = s[i + 1 : j].replace(c * 2, c)
        if quoted is not None and ("I" in quoted or "a" in quoted):
            texts = re.split("[Ia]", quoted)
            out += [("t", text, None)] if text else []
            ids = quoted.strip() in ("I", "") or re.fullmatch(r"\s*I\Wa\s*", quoted)
            pre, post = ("", "") if ids else (texts[0].lstrip(), texts[-1].rstrip())
            out.append(("q", "", (len(texts) - 1, pre, texts[1:-1], post)))
            i, text = j + 1, ""
        elif c in "Ia":
            out += [("t", text, None)] if text else []
            out.append((c, "", None))
            i, text = i + 1, ""
        else:
            text += c
            i += 1
    return out + ([("t", text, None)] if text else [])


def _splits(gap: str, kinds: list[str], kind: str, behind: str, strong: bool) -> bool:
    if not STRONG.isdisjoint(gap) or (kinds[-1] == "I" and kind == "I"):
        return True
    if kinds == ["I"] and kind == "a" and len(gap) == 1 and not gap.isspace() and gap not in "\"'":
        return behind == "-"
    if kinds[0] == "I" and (kind == "I" or kinds == ["I", "a"]):
        return True
    return not strong and (not WEAK.isdisjoint(gap) or len(gap) - len(gap.lstrip()) > 1)


def _edge(gap: str, strong: bool, last: bool) -> str:
    """What of a text between two values belongs to the value behind it (last), or to the one before it."""
    cuts = STRONG if strong else WEAK
    at = [i for i, c in enumerate(gap) if c in cuts]
    part = (gap[at[-1] + 1 :] if at else gap) if last else (gap[: at[0]] if at else "" if gap.isspace() else gap)
    return part.strip(" \t\r\n\"'[](){}")


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("at", pa.int32()), ("pre", pa.string()), ("seps", pa.list_(pa.string())), ("post", pa.string())]))
    for batch in batches:
        rules = [[{"at": at, "pre": pre, "seps": list(seps), "post": post} for at, pre, seps, post in splitting_rule(s)] for s in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, kind)], ["_s", "_rule"])


def unpack(df: DataFrame, key: str, field: str, value: str = "value") -> DataFrame:
    """(key, pos, value): one row per value of `field`, pos from 1 in order of writing.

    Rows repeated in key and field count once; a missing field (null, blank, NA, N/A, null, None, [] or -) gives no rows; empty places
    between delimiters don't count; repeated values do. Values in quotes come out whole and without the quotes; see `splitting_rule` for
    the rest. Rules are resolved once per distinct skeleton. The rule table is broadcast only
    after its size has been measured, else joined by shuffle."""
    rows = df.select(F.col(key).alias("_k"), F.col(field).alias("_f")).where(~is_missing(F.col("_f"))).distinct()
    rows = rows.withColumn("_s", skeleton(F.col("_f")))
    skeletons = rows.select("_s").distinct()
    size = skeletons.agg(F.sum(F.length("_s")).alias("n")).head()["n"] or 0
    rules = skeletons.mapInArrow(_rules, f"_s string, _rule {RULE}")
    rules = F.broadcast(rules) if size <= BROADCAST_CHARS else rules
    runs = F.regexp_extract_all("_f", F.lit(WORD), F.lit(0))
    run = lambda i: F.element_at(F.col("_runs"), i)
    more = lambda r: F.array_join(F.transform(r["seps"], lambda sep, i: F.concat(sep, run(r["at"] + i + 2))), "")
    values = F.transform("_rule", lambda r: F.concat(r["pre"], run(r["at"] + 1), more(r), r["post"]))
    return (
        rows.join(rules, "_s")
        .withColumn("_runs", runs)
        .select(F.col("_k").alias(key), F.posexplode(values).alias("_p", value))
        .select(key, (F.col("_p") + 1).cast("long").alias("pos"), value)
    )
