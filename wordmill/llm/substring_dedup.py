"""Exact repeated passages: fixed blocks of smaller documents, probed by rolling windows.

A passage of ``WINDOW`` = 13 words that starts anywhere in a document holds one of the
document's non-overlapping blocks of 7 words whole. So the blocks of all documents are the
index, and every rolling window of 7 words probes it.

1. Map tasks hash the windows and send them to parts by hash, as arrays: blocks first, with the
   least document of a task that has them, then probes. A part reads its blocks into one sorted
   array and lets the probes stream by; a probe hits if a smaller document has the block.
2. Documents with hits extend them: all windows of 13 words around a hit are hashed anew, in
   full, and sent to parts the same way, which keep the least document per window and answer
   which windows of which documents a smaller document starts too.
3. Those windows are looked up in the document again; the words they cover are removed.

Short hashes in step 1 only cost a few needless extensions; step 2 tells windows apart by a hash
of 128 bits, a part of which is the number of the part. A passage that any number of documents
share costs one entry per document and window and never a pair of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import materialise

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
PART_BYTES = 8 << 20  # text per part
FLUSH = 1 << 20  # windows a task holds before it sends them on

_SENT = "part long, kind int, docs binary, keys binary"
_FOUND = "doc_id long, found binary"


class Words:
    """The words of a text and hashes of runs of them."""

    def __init__(self, text: bytes):
        self.words = text.split()  # of bytes: ASCII white space only
        self.joined = b" ".join(self.words)
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        ends = np.cumsum(sizes + 1) - 1
        self.starts, self.ends = (ends - sizes).tolist(), ends.tolist()

    def __len__(self) -> int:
        return len(self.words)

    def short(self, width: int) -> np.ndarray:
        """64-bit hashes of all runs of ``width`` words."""
        digest, joined = xxhash.xxh3_64_intdigest, self.joined
        spans = zip(self.starts, self.ends[width - 1 :])
        return np.array([digest(joined[a:b]) for a, b in spans], dtype=np.uint64)

    def full(self, width: int, at: np.ndarray) -> np.ndarray:
        """128-bit hashes of the runs of ``width`` words that start at ``at``, as two columns."""
        digest, joined, starts, ends = xxhash.xxh3_128_digest, self.joined, self.starts, self.ends
        found = b"".join([digest(joined[starts[i] : ends[i + width - 1]]) for i in at.tolist()])
        return np.frombuffer(found, dtype=">u8").reshape(-1, 2).astype(np.uint64)


class _Outbox:
    """Collects entries ``part, kind, key, doc`` and yields them as rows of arrays."""

    def __init__(self, key_type):
        self.key_type, self.entries, self.size = key_type, [], 0

    def put(self, kind: int, part: np.ndarray, key: np.ndarray, doc: int | np.ndarray):
        self.entries.append((kind, part, key, np.broadcast_to(np.asarray(doc, np.int64), key.shape)))
        self.size += len(key)

    def flush(self) -> pd.DataFrame:
        rows = {"part": [], "kind": [], "docs": [], "keys": []}
        for kind in (0, 1):
            own = [entry for entry in self.entries if entry[0] == kind]
            if not own:
                continue
            part = np.concatenate([entry[1] for entry in own])
            key = np.concatenate([entry[2] for entry in own])
            doc = np.concatenate([entry[3] for entry in own])
            order = np.lexsort((doc, key, part))
            part, key, doc = part[order], key[order], doc[order]
            same = (part[1:] == part[:-1]) & (key[1:] == key[:-1])
            if kind == 1:  # a probe needs an answer for each document, a block only the least one
                same &= doc[1:] == doc[:-1]
            first = np.concatenate([[True], ~same])
            part, key, doc = part[first], key[first], doc[first]
            # In order of the documents their differences are small numbers, which pack well.
            order = np.lexsort((doc, part))
            part, key, doc = part[order], key[order], doc[order]
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            for p, docs, keys in zip(part[np.concatenate([[0], cuts])], np.split(doc, cuts), np.split(key, cuts)):
                rows["part"].append(int(p))
                rows["kind"].append(kind)
                rows["docs"].append(np.diff(docs, prepend=0).astype("<i8").tobytes())
                rows["keys"].append(keys.astype(self.key_type).tobytes())
        self.entries, self.size = [], 0
        return pd.DataFrame(rows)


def _dealt(pieces, key_type, entries) -> Iterator[pd.DataFrame]:
    """Rows of arrays from what ``entries(doc_id, text, ...)`` yields for each document."""
    out = _Outbox(key_type)
    for rows in pieces:
        for row in rows.itertuples(index=False):
            for kind, part, key in entries(*row):
                out.put(kind, part, key, row[0])
            if out.size >= FLUSH:
                yield out.flush()
    if out.size:
        yield out.flush()


def _short_keys(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(32)) % np.uint64(parts), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _blocks_and_probes(parts: int):
    def entries(doc_id, text):
        words = Words(text)
        if len(words) >= WINDOW:
            part, key = _short_keys(words.short(BLOCK), parts)
            yield 0, part[::BLOCK], key[::BLOCK]
            yield 1, part, key

    return lambda pieces: _dealt(pieces, "<u4", entries)


def _extensions(parts: int):
    def entries(doc_id, text, found):
        words = Words(text)
        if len(words) < WINDOW:
            return
        part, key = _short_keys(words.short(BLOCK), parts)
        hits = np.frombuffer(found, dtype="<u8")
        at = np.flatnonzero(np.isin(part << np.uint64(32) | key, hits))
        around = (at[:, None] - np.arange(WINDOW - BLOCK + 1)).ravel()
        starts = np.unique(around[(around >= 0) & (around <= len(words) - WINDOW)])
        full = words.full(WINDOW, starts)
        yield 0, full[:, 0] % np.uint64(parts), full[:, 1]
        yield 1, full[:, 0] % np.uint64(parts), full[:, 1]

    return lambda pieces: _dealt(pieces, "<u8", entries)


def _entries(row, key_type: str) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(row.docs, dtype="<i8")), np.frombuffer(row.keys, dtype=key_type)


def _answer(key_type: str, with_least: bool, parts: int):
    """For sorted rows of one part after another: which entries a smaller document has too.

    Answers are entries again, sent to parts by document. ``with_least``: the smaller document
    itself is told as well.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Outbox("<u8")
        part, blocks, known, least, hit = None, [], None, None, None

        def tell(docs, keys):
            keys = keys.astype(np.uint64)
            if key_type == "<u4":
                keys = keys | np.uint64(part << 32)
            mixed = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            out.put(1, (mixed >> np.uint64(32)) % np.uint64(parts), keys, docs)

        def close():
            if with_least and hit is not None and hit.any():
                tell(least[hit], known[hit])

        for rows in batches:
            for row in rows.itertuples(index=False):
                if row.part != part:
                    close()
                    part, blocks, known, hit = row.part, [], None, None
                docs, keys = _entries(row, key_type)
                if row.kind == 0:
                    blocks.append((keys, docs))
                    continue
                if known is None:
                    if not blocks:
                        continue
                    known, least = (np.concatenate(x) for x in zip(*blocks))
                    order = np.lexsort((least, known))
                    known, least = known[order], least[order]
                    first = np.concatenate([[True], known[1:] != known[:-1]])
                    known, least, blocks = known[first], least[first], []
                    hit = np.zeros(len(known), bool)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                repeats = (known[at] == keys) & (least[at] < docs)
                if repeats.any():
                    hit[at[repeats]] = True
                    tell(docs[repeats], keys[repeats])
                if out.size >= FLUSH:
                    yield out.flush()
        close()
        if out.size:
            yield out.flush()

    return run


def _by_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document from sorted rows of entries; a part's documents are in no other part."""

    def gathered(pieces):
        docs, keys = (np.concatenate(x) for x in zip(*pieces))
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])])
        return docs[new], keys[new]

    def packed(pieces):
        docs, keys = gathered(pieces)
        cuts = np.concatenate([[0], np.flatnonzero(docs[1:] != docs[:-1]) + 1, [len(docs)]])
        data = keys.astype("<u8").tobytes()
        found = [data[8 * a : 8 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return pd.DataFrame({"doc_id": docs[cuts[:-1]], "found": found})

    part, pieces, size = None, [], 0
    for rows in batches:
        for row in rows.itertuples(index=False):
            if row.part != part:
                if pieces:
                    yield packed(pieces)
                part, pieces, size = row.part, [], 0
            pieces.append(_entries(row, "<u8"))
            size += len(pieces[-1][0])
            if size >= FLUSH:  # repeats, as of rows that agree in doc_id, count once
                pieces = [gathered(pieces)]
                size = 0
    if pieces:
        yield packed(pieces)


def _answered(sent: DataFrame, key_type: str, with_least: bool, parts: int) -> DataFrame:
    """``doc_id, found`` with all that was found of a document, kept."""
    dealt = sent.repartition("part").sortWithinPartitions("part", "kind")
    told = dealt.mapInPandas(_answer(key_type, with_least, parts), _SENT)
    return materialise(told.repartition("part").sortWithinPartitions("part").mapInPandas(_by_document, _FOUND), "found")


def _without(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
    rows = []
    for text, windows in zip(texts, found):
        words = Words(text)
        n, kept, removed = len(words), words.joined, 0
        if windows is not None and len(windows) and n >= WINDOW:
            full = words.full(WINDOW, np.arange(n - WINDOW + 1))
            at = np.flatnonzero(np.isin(full[:, 1], np.frombuffer(windows, dtype="<u8")))
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + WINDOW, -1)
            stays = np.cumsum(edges[:-1]) == 0
            removed = int(n - stays.sum())
            kept = b" ".join([word for word, stay in zip(words.words, stays.tolist()) if stay])
        rows.append((n, removed, kept))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def _final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = _without(rows["text"], rows["found"])
        out["kept_sha256"] = [hashlib.sha256(kept).hexdigest() for kept in out["kept"]]
        yield pd.concat([rows[["id", "named"]].reset_index(drop=True), out.drop(columns="kept")], axis=1)


def _kept_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = _without(rows["text"], rows["found"])
        yield rows[["id", "named"]].reset_index(drop=True).assign(kept=out["kept"].str.decode("utf-8"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, found``: for documents that repeat passages of smaller ones, those windows."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    named = _texts(docs.where("doc_id IS NOT NULL"))
    hits = _answered(named.mapInPandas(_blocks_and_probes(parts), _SENT), "<u4", True, parts)
    extended = named.join(hits, "doc_id").select("doc_id", "text", "found")
    return _answered(extended.mapInPandas(_extensions(parts), _SENT), "<u8", False, parts)


def _over_texts(docs: DataFrame, run, columns: str) -> DataFrame:
    # A null would turn the numbers of a whole batch into floating point.
    joined = _texts(docs).join(repeated_windows(docs), "doc_id", "left")
    plain = joined.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("named"), "text", "found")
    out = plain.mapInPandas(run, f"id long, named boolean, {columns}")
    return out.select(F.when(F.col("named"), F.col("id")).alias("doc_id"), *[c for c in out.columns if c not in ("id", "named")])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    Null and empty texts have no words. Rows without a doc_id lose nothing and take nothing from
    others; rows that agree in doc_id take nothing from each other. Other columns are not read.
    """
    return _over_texts(docs, _final, "n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, kept``: the words that stay, joined by blanks."""
    return _over_texts(docs, _kept_text, "kept string")


SQL = f"""
  WITH cut AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
  ), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS i,
           unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS g
    FROM cut WHERE len(w) >= {WINDOW}
  ), least AS (
    SELECT g, min(doc_id) AS first FROM windows GROUP BY g
  ), covered AS (
    SELECT DISTINCT doc_id, i + k AS i
    FROM windows JOIN least USING (g), range({WINDOW}) r(k) WHERE first < doc_id
  ), placed AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM cut
  ), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM placed ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
  )
  SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
  FROM cut LEFT JOIN kept USING (doc_id)"""
