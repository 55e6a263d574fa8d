"""Packing documents into token sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

Each document's ids, with an end id after them, are cut into pieces of ``length`` ids and a rest.  Full pieces are sequences
of their own.  Documents fall into groups by hash, about ``group_docs`` in each, and the rests of a group are packed on
their own: longest first, each into the first sequence with room, which a tournament tree over the sequences' free room
finds in logarithmic time.  Then the last sequences of a group are cut up to fill the gaps of the others, so a group leaves
at most one sequence short.

A document's group comes from its id, its text and, where a task meets equal rows again or the id is null, the copy's number
and the task's: copies spread over all groups.  Equal rows are interchangeable, so counting them gives a task that runs again
the same groups whatever order it reads them in.

Defined results for odd input: a null or empty text is a document of the end id alone; a null id is packed like others.
Repeated rows are documents of their own.  Documents of equal length are packed in order of id, then place.  Texts of any
length are encoded whole, in steps.  An empty table gives an empty result.  Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import tokens
from llm.common import table

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(path: str, length: int, groups: int, end: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail, full = tokens.encoder(path), end.to_bytes(4, "little"), 4 * length
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        met: dict[bytes, int] = {}  # copies so far by a digest of id and text: about a hundred bytes a document of this task
        for b in batches:
            out: list[tuple] = []
            size = 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                t = text.as_py() or ""
                row = hashlib.blake2b(b"%d|" % doc if doc is not None else b"|", digest_size=12)
                row.update(t.encode("utf-8", "replace"))
                copy = met[row.digest()] = met.get(row.digest(), -1) + 1
                if copy or doc is None:
                    row.update(b"|%d|%d" % (copy, task))
                group = int.from_bytes(row.digest()[:6], "little") % groups
                ids = enc.ids(t) + tail
                n = len(ids) // 4
                for at in range(0, n - n % length, length):
                    out.append((group, doc, at, length, zlib.crc32(memoryview(ids)[4 * at : 4 * at + full]), n, None))
                if n % length:
                    out.append((group, doc, n - n % length, n % length, None, n, ids[4 * (n - n % length) :]))
                size += 4 * (n % length) + 40 * (n // length + 1)
                if size > 8 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return of


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [("g", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], [n for n, _ in types])


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Items of each bin: longest first, each into the first bin with room.  ``tree`` holds, at each node of a complete
    binary tree over the bins, the most free room below it; a bin is found by going down from the root, left where it can."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree, bins = [room] * (2 * leaves), []
    for i in order:
        need, at = sizes[i], 1
        while at < leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(i)
        tree[at] -= need
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
    return bins


def pack(sizes: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, first, size): first-fit decreasing, then the last bins fill the gaps of the others."""
    bins = [[(i, 0, sizes[i]) for i in b] for b in first_fit_decreasing(sizes, room)]
    free = [room - sum(p[2] for p in b) for b in bins]
    k = 0
    while k < len(bins) - 1:
        if not free[k]:
            k += 1
            continue
        i, first, size = bins[-1].pop()
        take = min(size, free[k])
        bins[k].append((i, first + size - take, take))
        free[k] -= take
        free[-1] += take
        if take < size:
            bins[-1].append((i, first, size - take))
        if not bins[-1]:
            bins.pop()
            free.pop()
    return bins


def _group(room: int):
    def of(pieces: pa.Table) -> pa.Table:
        """Sequences of a group; ids stay in Arrow, where a null one doesn't change the others."""
        whole = pc.is_null(pieces["ids"])
        rest = pieces.filter(pc.invert(whole)).sort_by([(c, "ascending") for c in ("doc_id", "start", "length")])
        full = pieces.filter(whole)
        base, starts, ids, rows = pieces["g"][0].as_py() << 32, rest["start"].to_pylist(), rest["ids"], []
        for s, b in enumerate(pack(rest["length"].to_pylist(), room)):
            at = 0
            for i, first, size in b:
                rows.append((i, starts[i] + first, size, zlib.crc32(memoryview(ids[i].as_buffer())[4 * first : 4 * (first + size)]), base + s, at))
                at += size
        n = (rows[-1][4] - base + 1) if rows else 0
        i, start, size, crc, sequence, at = (pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6))
        packed = [rest["doc_id"].take(i), start, size, crc, rest["doc_tokens"].take(i), sequence, at]
        alone = [full["doc_id"], full["start"], full["length"], full["crc"], full["doc_tokens"], pa.array(base + n + np.arange(len(full))), pa.array(np.zeros(len(full), dtype=np.int64))]
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        return pa.concat_tables([pa.table(dict(zip(names, x))) for x in (packed, alone)])

    return of


def pack_documents(docs: DataFrame, length: int = 1024, group_docs: int = 2048, end: int = 0, path: str | None = None) -> DataFrame:
    """A row for each piece: its document, place and size there, checksum of its ids, sequence and place in that."""
    groups = max(1, round(docs.count() / group_docs))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(path or tokens.default_path(), length, groups, end), "g int, doc_id long, start long, length long, crc long, doc_tokens long, ids binary")
    return pieces.groupBy("g").applyInArrow(_group(length), SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
