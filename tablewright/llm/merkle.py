"""Merkle trees over the sections and paragraphs of a text.

A paragraph is a line. A section is a run of paragraphs; it starts at a paragraph that follows an empty
line, at a heading (``#``), or at one whose digest ends in three zero bits, so sections of long plain texts
fall into step again after an insertion. Leaves are phrases: a paragraph is cut after the spaces that follow
certain byte pairs, about every eighth word, wherever they stand.

Digests are BLAKE2b of 16 bytes: of a leaf's UTF-8 text, and of the child digests above, with the level
in front. Equal texts, and only they, have equal roots. Trees that differ are compared from the top: equal
branches are skipped, so the differing leaves locate the edits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow, mix64, text_or_empty

#: True for the byte pairs (as first * 256 + second) in front of a space after which a leaf may end.
_CUT = (mix64(np.arange(65536, dtype=np.uint64) + np.uint64(1)) & np.uint64(7)) == 0

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, changed_from long, changed_chars long"
)


class Node(NamedTuple):
    digest: bytes
    size: int  # code points
    children: tuple[Node, ...]


def _digest(level: bytes, data: bytes) -> bytes:
    return blake2b(level + data, digest_size=16).digest()


def _parent(level: bytes, children: list[Node]) -> Node:
    return Node(_digest(level, b"".join([c.digest for c in children])), sum([c.size for c in children]), tuple(children))


def leaves(line: str) -> list[str]:
    """The phrases of a line, in order; they add up to it."""
    raw = line.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    spaces = np.flatnonzero(data[2:] == 0x20) + 2
    cuts = spaces[_CUT[data[spaces - 2].astype(np.int64) << 8 | data[spaces - 1]]] + 1
    if not len(cuts):
        return [line]
    ends = [*cuts.tolist(), len(raw)]
    if len(raw) == len(line):
        return [line[a:b] for a, b in zip([0, *ends], ends, strict=False) if a < b]
    return [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends, strict=False) if a < b]


def tree(text: str | None) -> Node:
    """The tree of a text; null is like the empty text, whose root has no children."""
    sections: list[Node] = []
    section: list[Node] = []
    fresh = False
    for line in _lines(text or ""):
        paragraph = _paragraph(line)
        starts = fresh or line.startswith("#") or paragraph.digest[-1] & 7 == 0
        if section and starts:
            sections.append(_parent(b"s", section))
            section = []
        section.append(paragraph)
        fresh = not line.strip()
    if section:
        sections.append(_parent(b"s", section))
    return _parent(b"r", sections)


def _lines(text: str) -> list[str]:
    parts = text.split("\n")
    lines = [p + "\n" for p in parts[:-1]]
    return [*lines, parts[-1]] if parts[-1] else lines


def _paragraph(line: str) -> Node:
    found = [Node(_digest(b"l", p.encode("utf-8", "surrogatepass")), len(p), ()) for p in leaves(line)]
    return _parent(b"p", found)


def changed(a: Node, b: Node, at: int = 0) -> Iterator[tuple[int, int]]:
    """(start, size) of the leaves of ``a`` that ``b`` lacks, in order.

    Children of equal digest are matched wherever they stand; the rest are compared one level down with
    all the rest of the other side, so a paragraph that moved into another section still matches.
    """
    yield from _changed([(at, a)], [b])


def _changed(left: list[tuple[int, Node]], right: list[Node]) -> Iterator[tuple[int, int]]:
    have = Counter([n.digest for n in right])
    rest: list[tuple[int, Node]] = []
    for at, node in left:
        if have[node.digest] > 0:
            have[node.digest] -= 1
        else:
            rest.append((at, node))
    if not rest:
        return
    if not rest[0][1].children:
        for at, node in rest:
            if node.size:
                yield at, node.size
        return
    unmatched = []
    for node in right:
        if have[node.digest] > 0:
            have[node.digest] -= 1
            unmatched.append(node)
    below = []
    for at, node in rest:
        for child in node.children:
            below.append((at, child))
            at += child.size
    yield from _changed(below, [c for n in unmatched for c in n.children])


def likeness(a: Node, b: Node) -> float:
    """Share of the code points of both texts in leaves that they have in common; 1 for equal texts."""
    if a.digest == b.digest:
        return 1.0
    lost = sum(size for _, size in changed(a, b))
    return 2 * (a.size - lost) / (a.size + b.size)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows (pid, guest, known, doc_id, text): ranges of ascending doc_id, each with the row after its last.

    The first row of every range goes to the range before it as a guest (that of the first range to the
    last). Only the bounds and the first id of each range pass through the driver.
    """
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("known", F.col("doc_id").isNotNull())
    ranges = 4 * tasks
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    numbered = rows.withColumn("_at", F.col("doc_id").cast("double"))
    splits = [float("-inf"), *(bounds or [0.0]), float("inf")]
    found = Bucketizer(inputCol="_at", outputCol="_range", splits=splits, handleInvalid="keep").transform(numbered)
    pid = F.when(F.col("known"), F.col("_range").cast("int")).otherwise(F.lit(0))
    rows = found.withColumn("pid", pid).select("pid", "known", "doc_id", "text")
    firsts = rows.groupBy("pid").agg(F.min(F.struct("known", "doc_id")).alias("first")).collect()  # a row per range
    firsts = sorted((r.pid, r.first.known, r.first.doc_id) for r in firsts)
    before = [(known, doc_id, pid, firsts[i - 1][0]) for i, (pid, known, doc_id) in enumerate(firsts)]
    table = spark.createDataFrame(before, "first_known boolean, first_id long, first_pid int, before int")
    # At most ``ranges`` rows.
    own = (F.col("pid") == F.col("first_pid")) & (F.col("known") == F.col("first_known")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    guests = rows.join(F.broadcast(table), own).groupBy("before", "known", "doc_id").agg(F.min("text").alias("text"))
    guests = guests.withColumnRenamed("before", "pid")
    columns = ["pid", "guest", "known", "doc_id", "text"]
    both = rows.withColumn("guest", F.lit(0)).select(columns).unionByName(guests.withColumn("guest", F.lit(1)).select(columns))
    return both.repartition(tasks, "pid").sortWithinPartitions(*columns)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness, for rows of (doc_id, text).

    The edited text ends in the start of the next row's text; rows are ordered by doc_id (null first),
    rows of one doc_id by text, and the first row follows the last. A single row follows itself. Null texts
    are empty; empty texts are alike. ``changed_from`` is where the first leaf that the edited text lacks
    begins (null if none), ``changed_chars`` the code points of all of them. Other columns are ignored.
    """
    rows = _with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # pid, doc_id, text, tree
        out: list[tuple] = []
        size = 0
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for pid, guest, _, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                here = tree(text)
                if held is not None and held[0] == pid:
                    _, of, old, was = held
                    new = edited(old, text)
                    then = tree(new)
                    lost = list(changed(was, then)) if was.digest != then.digest else []
                    gone = sum(n for _, n in lost)
                    near = 1.0 if was.digest == then.digest else 2 * (was.size - gone) / (was.size + then.size)
                    sha = sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((of, len(old), sha, was.digest.hex(), then.digest.hex(), near, likeness(was, here), lost[0][0] if lost else None, gone))
                    size += 1
                held = None if guest else (pid, doc_id, text, here)
                if size >= 2000:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    return map_arrow(rows, run, SCHEMA)
