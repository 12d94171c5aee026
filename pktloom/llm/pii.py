"""Personal data by patterns and by bootstrapped contextual extraction.

Seeds are what the four base patterns find. Each seed, and each other token that looks like an identifier, has lexical
patterns: the two words before it, the words around it, and its own form, in which digits and runs of letters are alike. So an
identifier that a base match swallowed with its neighbour is found by the form of the others. Patterns and instances form a
graph that Spark scores round by round. In a round, patterns are induced from the instances accepted so far: one with enough
of them, and with a high enough share of their scores among all its instances, is confident. What stands in a confident pattern and has its
kind's shape is accepted with the pattern's score, and induces patterns in the next round; rounds end when nothing is added.
One pass over the texts makes the graph; what follows reads tables of instances only.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_PER_CORE, dropped, free_name, slices, text_batches, written

KINDS = ("email", "ip", "card", "phone")
#: Score that a pattern needs, and distinct accepted instances that it needs.
CONFIDENT, SUPPORT = 0.8, 5
#: Characters of a word that are its context, and beyond which a form is named by its digest.
LONG = 64

#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Tokens with a digit or @, from that character on; and numbers in groups.
_MARKED = re.compile(r"[0-9@]\S*")
_GROUPED = re.compile(r"(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&=/\\"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """Whether a number is 255 at most; int() refuses very long ones."""
    least = digits.lstrip("0")
    return len(least) <= 3 and int(least or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start: leftmost non-overlapping matches that pass their kind's test."""
    out = []
    if "@" in text:
        last, at = 0, text.find("@")
        while at >= 0:
            if at >= last:
                start = at
                while start > last and _LOCAL.match(text, start - 1):
                    start -= 1
                # an @ with nothing before it, or without a domain after it, is in no match
                if start < at and (m := _DOMAIN.match(text, at)):
                    out.append((0, start, m.end()))
                    last = m.end()
            at = text.find("@", at + 1)
    if "." in text:
        out += [(1, *m.span()) for m in IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def shape(token: str) -> int | None:
    """The kind whose looks a token has, if any."""
    digits = sum("0" <= c <= "9" for c in token)
    if "@" in token[1:-1] and token.count("@") == 1:
        return 0
    letters = sum(map(str.isalpha, token))
    if letters:
        return None
    if IP.fullmatch(token):
        return 1 if all(map(_octet, token.split("."))) else None
    if 13 <= digits <= 19 and CARD.fullmatch(token) and luhn(token.replace("-", "")):
        return 2
    return 3 if 9 <= digits <= 15 else None


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Tokens outside the base spans that look like an identifier, without overlaps."""
    taken = sorted((s, e) for _, s, e in base)
    out, k, last = [], 0, 0
    found = []
    for m in _MARKED.finditer(text):
        start, end = m.span()
        while start > last and not text[start - 1].isspace():
            start -= 1
        last = end
        token = text[start:end]
        start += len(token) - len(token.lstrip(_EDGE))
        token = token.strip(_EDGE)
        if token and (kind := shape(token)) is not None:
            found.append((start, start + len(token), kind))
    for m in _GROUPED.finditer(text) if found or _DIGIT.search(text) else ():
        if not (m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] in "+.")) and shape(m.group()) == 3:
            found.append((*m.span(), 3))
    last = 0
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start < last or k < len(taken) and taken[k][0] < end:
            continue
        out.append((kind, start, end))
        last = end
    return out


_LETTERS = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")


def _form(token: str) -> str:
    """What digits and letters a token has where; a long form is named by its digest."""
    form = _DIGIT.sub("9", _LETTERS.sub("a", token))
    return form if len(form) <= LONG else "#" + xxhash.xxh3_128_hexdigest(form.encode("utf-8", "replace"))


def contexts(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    """The lexical patterns of each span: the two words before it, the words before and after it, and its own form.

    Words are what white space separates; of a word that a span is part of, the rest is a word, too. Of a long word it is the LONG
    characters next to the span.
    """
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in at]
    out = []
    for start, end in spans:
        k = bisect_left(starts, start)  # words that begin before the span
        before = [text[max(s, min(e, start) - LONG) : min(e, start)].lower() for s, e in at[max(0, k - 2) : k]]
        j = bisect_right(starts, end) - 1
        j += at[j][1] <= end  # the first word that goes on after the span
        after = [text[max(s, end) : min(e, max(s, end) + LONG)].lower() for s, e in at[j : j + 1]]
        own = ["S " + _form(text[start:end])]
        if len(before) == 2:
            own.append("L " + " ".join(before))
        if before and after:
            own.append("LR " + before[-1] + " _ " + after[0])
        out.append(own)
    return out


_SCANNED = "row_id bigint, doc_id bigint, base array<struct<kind:int,start:int,end:int>>, base_sha256 string, seen array<struct<kind:int,start:int,end:int,seed:boolean,instance:bigint,patterns:array<string>>>"


def _instance(text: str) -> int:
    """A 64-bit name of an identifier, whatever separates its parts."""
    return xxhash.xxh64_intdigest("".join(c for c in text.lower() if c.isalnum() or c == "@").encode("utf-8", "replace")) >> 1


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row, and its column; a table's rows come in the same order again, so it stays the same."""
    row = free_name(docs, "row_id")
    return docs.withColumn(row, F.monotonically_increasing_id()), row


def scanned(numbered: DataFrame, row_col: str, text_col: str = "text", id_col: str | None = None) -> DataFrame:
    """A row for each row: row_id, doc_id, its base spans, and the instances seen with their patterns; no texts."""
    text_batches(numbered.sparkSession)
    span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    seen_type = pa.list_(pa.struct([*span, ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))]))
    doc_id = F.lit(None) if id_col is None else F.col(id_col)
    rows = numbered.select(F.col(row_col).alias("row_id"), doc_id.cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            all_base, digests, all_seen = [], [], []
            for text in b.column(2).to_pylist():
                text = text or ""
                base = base_spans(text)
                all_base.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every = [(True, *x) for x in base] + [(False, *x) for x in candidates(text, base)]
                patterns = contexts(text, [(s, e) for _, _, s, e in every])
                all_seen.append([{"kind": k, "start": s, "end": e, "seed": seed, "instance": _instance(text[s:e]), "patterns": own} for (seed, k, s, e), own in zip(every, patterns)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(all_base, pa.list_(pa.struct(span))), pa.array(digests, pa.string()), pa.array(all_seen, seen_type)], names=["row_id", "doc_id", "base", "base_sha256", "seen"])

    return rows.mapInArrow(scan, _SCANNED)


def confident_patterns(edges: DataFrame, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """(kind, pattern, score) of the patterns that reach the score, of edges (kind, pattern, instance, seed).

    Seeds are accepted with score 1. In each round a pattern's score is the sum of its accepted distinct instances' scores, over one more
    than all its distinct instances; one that reaches `confident` with `support` accepted instances is confident, and its
    other instances are accepted with the best such score. A pattern that is confident stays so. Rounds go on until one adds nothing, so a pattern can enter
    through instances that others found. Scores are grouped sums and maxima, with partial aggregation, and meet in joins of
    written tables, which can split a hot pattern or instance.
    """
    graph = edges.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"))
    sizes = graph.groupBy("kind", "pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)  # the others never can
    sizes = written(sizes, "sizes", FEW_PER_CORE)
    graph = written(graph.join(sizes, ["kind", "pattern"]), "graph", FEW_PER_CORE)
    known = written(graph.where("seed").select("kind", "instance", F.lit(1.0).alias("known")).distinct(), "known", FEW_PER_CORE)
    sure = None
    while True:
        scores = graph.join(known, ["kind", "instance"]).groupBy("kind", "pattern").agg((F.sum("known") / (F.max("n") + 1)).alias("score"), F.count("*").alias("accepted"))
        scores = scores.where((F.col("accepted") >= support) & (F.col("score") >= confident)).select("kind", "pattern", "score")
        if sure is not None:
            scores = sure.unionByName(scores.join(sure, ["kind", "pattern"], "left_anti"))
        scores = written(scores, "scores", FEW_PER_CORE)
        found = graph.join(scores, ["kind", "pattern"]).join(known.select("kind", "instance"), ["kind", "instance"], "left_anti")
        found = written(found.groupBy("kind", "instance").agg(F.max("score").alias("known")), "found", FEW_PER_CORE)
        if sure is not None:
            dropped(sure)
        sure = scores
        if found.isEmpty():
            break
        both = written(known.unionByName(found), "known", FEW_PER_CORE)
        dropped(known)
        dropped(found)
        known = both
    for table in (sizes, graph, known, found):
        dropped(table)
    return sure


def added(found: DataFrame, **options) -> DataFrame:
    """(row_id, new) of the rows of a scan that stand in confident patterns: spans beyond the base ones."""
    seen = found.select("row_id", F.explode("seen").alias("s")).select("row_id", "s.*")
    edges = seen.select("kind", "seed", "instance", F.explode("patterns").alias("pattern"))
    sure = confident_patterns(edges, **options)
    new = seen.where("not seed").select("row_id", "kind", "start", "end", F.explode("patterns").alias("pattern")).join(sure.select("kind", "pattern"), ["kind", "pattern"])
    return written(new.groupBy("row_id").agg(F.collect_set(F.struct("kind", "start", "end")).alias("new")), "added", FEW_PER_CORE)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for each row; the counts and digest are of base spans.

    Spans are by kind, then start. Null and empty texts have none. Repeated rows stay apart; an empty table gives an
    empty one. docs must give its rows in the same order each time it is read, as a table does.
    """
    found = written(scanned(*_numbered(docs), text_col, id_col), "scanned")
    both = found.drop("seen").join(added(found, **options), "row_id", "left")
    every = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    names = F.array(*map(F.lit, KINDS))
    listed = F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))

    def count(k: int) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(len(KINDS))]
    return both.select("doc_id", *counts, "base_sha256", F.array_join(listed, ",").alias("spans"), F.size(F.coalesce("new", F.array().cast(found.schema["base"].dataType))).cast("bigint").alias("n_added"))


def without(text: str | None, spans: Iterable[tuple[int, int, int]]) -> str | None:
    """The text with its spans, as (kind number, start, end), replaced by their kinds.

    Of spans that overlap the one that starts first stands, and the earlier kind among equals.
    """
    out, at = [], 0
    for s, k, e in sorted((s, k, e) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def masked(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with all their columns, their texts with each span replaced by its kind in brackets.

    The first pass keeps no texts; in the second, base spans are found again and only the added ones join in, which are
    few, so that texts are neither stored nor, where Spark broadcasts the added ones, shuffled.
    """
    numbered, row = _numbered(docs)
    found = written(scanned(numbered, row, text_col), "scanned")
    name = free_name(docs, "new")
    new = added(found, **options).select(F.col("row_id").alias(row), F.col("new").alias(name))
    rows = numbered.join(new, row, "left").select(*[F.col(f"`{c}`") for c in docs.columns], name)
    at = docs.columns.index(text_col)

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for text, new in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                texts.append(without(text, [*base_spans(text or ""), *((x["kind"], x["start"], x["end"]) for x in new or ())]))
            columns = [pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    text_batches(docs.sparkSession)
    return rows.mapInArrow(mask, docs.schema)
