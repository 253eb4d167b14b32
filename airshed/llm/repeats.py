"""Removing passages that repeat an earlier document, by fixed-block anchors.

A window of 50 words contains a whole block of 25 words at a multiple of 25 of its
document.  So an index of the non-overlapping blocks of all documents, probed with every
rolling window of 25 words, finds every document that shares a 50-word window with
another.  In those documents hits are extended: windows of 50 words are compared, and
runs of repeated windows are the maximal exact repeats.

How it is laid out:

1. Documents are packed into chunks of about two megabytes, compressed, one row each, in
   the shared folder.  Whatever comes later refers to (chunk, place).
2. Index and probes: a chunk sends every distinct 25-word hash once, with a mark whether
   it is a block, to one of the hash buckets.  A hash in two chunks, a block in one
   of them, makes its documents candidates.  Documents that share a hash within their
   chunk are candidates at once.
3. Extension: a chunk sends every distinct 50-word hash of its candidates once, with the
   smallest id.  The bucket answers with one bit per hash: whether a smaller id has it.
4. Chunks mark their windows and give back what is left.

A passage in a third of all documents is one entry per chunk and hash, so no bucket grows
with the number of its copies.  Windows are told apart by 64 bits and the bucket's
number, which comes from other bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from airshed.llm.words import WordHashes, mix, windows
from airshed.session import kept

WINDOW = 50
BLOCK = WINDOW // 2
CHUNK_BYTES = 2_000_000
CHUNK_DOCS = 30_000
#: Words whose hashes share a bucket.
BUCKET_WORDS = 1_000_000
_MARK = np.uint16(1 << 15)
_OTHER = 0xD6E8FEB86659FD93


def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def pack_chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (chunk, size, keys, texts): compressed texts of neighbouring rows, with their
    ids; a document with a null id is marked by a null place."""
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress, _ = _zstd()
        number = TaskContext.get().partitionId() << 32
        keys, texts, size = [], [], 0

        def chunk() -> pd.DataFrame:
            nonlocal number
            known = [k is not None and k == k for k in keys]
            numbers = np.array([k if g else 0 for k, g in zip(keys, known)], dtype="<i8")
            lengths = np.array([len(t) for t in texts], dtype="<u4")
            head = np.array(known, dtype=np.uint8).tobytes() + numbers.tobytes() + lengths.tobytes()
            number += 1
            return pd.DataFrame({"chunk": [number - 1], "docs": [len(keys)], "size": [size],
                                 "data": [compress(head + b"".join(texts))]})

        for batch in batches:
            column = batch["key"].astype(object).where(batch["key"].notna(), None)
            for k, t in zip(column, batch["text"]):
                data = (t or "").encode("utf-8", "replace")
                if keys and (size + len(data) > CHUNK_BYTES or len(keys) >= CHUNK_DOCS):
                    yield chunk()
                    keys, texts, size = [], [], 0
                keys.append(k)
                texts.append(data)
                size += len(data)
        if keys:
            yield chunk()

    return rows.mapInPandas(run, "chunk long, docs long, size long, data binary")


def _open(data: bytes, n: int, decompress) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = decompress(data)
    known = np.frombuffer(raw, dtype=np.uint8, count=n).astype(bool)
    keys = np.frombuffer(raw, dtype="<i8", count=n, offset=n)
    ends = 13 * n + np.cumsum(np.frombuffer(raw, dtype="<u4", count=n, offset=9 * n).astype(np.int64))
    starts = np.concatenate([[13 * n], ends[:-1]])
    return known, keys, [raw[a:b] for a, b in zip(starts, ends)]


def _send(bucket_of: np.ndarray, bits: int, columns: list[np.ndarray], compress) -> Iterator[tuple[int, bytes]]:
    """Entries of each bucket as one compressed piece, from arrays sorted by bucket."""
    edges = np.searchsorted(bucket_of, np.arange((1 << bits) + 1))
    for b in range(1 << bits):
        lo, hi = edges[b], edges[b + 1]
        if hi > lo:
            yield b, compress(np.int64(hi - lo).tobytes() + b"".join(c[lo:hi].tobytes() for c in columns))


def _top(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), dtype=np.int64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def anchors(chunks: DataFrame, bits: int) -> DataFrame:
    """Rows (bucket, chunk, data): distinct 25-word hashes of a chunk.  Buckets below zero
    carry the places of documents that share a hash within the chunk."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress, decompress = _zstd()
        hashes = WordHashes()
        for batch in batches:
            for number, n, data in zip(batch["chunk"], batch["docs"], batch["data"]):
                known, _, texts = _open(data, n, decompress)
                found = [windows(hashes.of_bytes(t), BLOCK) if k else np.zeros(0, dtype=np.uint64)
                         for k, t in zip(known, texts)]
                count = [len(f) for f in found]
                value = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
                place = np.repeat(np.arange(n, dtype=np.uint16), count)
                first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
                block = (np.arange(len(value)) - np.repeat(first, count)) % BLOCK == 0
                order = np.argsort(value, kind="stable")  # stable: places ascend within a hash
                value, place, block = value[order], place[order], block[order]
                new = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, dtype=np.int64)
                last = np.concatenate([new[1:], [len(value)]]) - 1 if len(new) else new
                local = np.zeros(n, dtype=bool)
                shared = place[new] != place[last]
                if shared.any():
                    local[place[np.repeat(shared, last - new + 1)]] = True
                marked = np.add.reduceat(block, new) > 0 if len(new) else np.zeros(0, dtype=bool)
                value, place = value[new], place[new] | np.where(marked, _MARK, np.uint16(0))
                low = (value << np.uint64(bits)) >> np.uint64(32)
                rows = [(b, number, d) for b, d in
                        _send(_top(value, bits), bits, [low.astype("<u4"), place.astype("<u2")], compress)]
                if local.any():
                    rows.append((-1 - int(number) % (1 << bits), number, _bits(local)))
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "data"])

    return chunks.select("chunk", "docs", "data").mapInPandas(run, "bucket long, chunk long, data binary")


def _gather(group: pd.DataFrame, kinds: list[str]) -> list[np.ndarray]:
    """The entries of all pieces of a bucket: their piece, then one array per kind."""
    _, decompress = _zstd()
    parts: list[list[np.ndarray]] = [[] for _ in range(len(kinds) + 1)]
    for i, data in enumerate(group["data"]):
        raw = decompress(data)
        n, at = int(np.frombuffer(raw, dtype="<i8", count=1)[0]), 8
        parts[0].append(np.full(n, i, dtype=np.int32))
        for k, kind in enumerate(kinds):
            parts[k + 1].append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates of one bucket: rows (chunk, places) as bits."""
    if group["bucket"].iloc[0] < 0:
        return group[["chunk", "data"]]
    piece, value, place = _gather(group, ["<u4", "<u2"])
    order = np.argsort(value, kind="stable")
    value, piece, place = value[order], piece[order], place[order]
    new = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.concatenate([new, [len(value)]]))
    block = np.add.reduceat((place & _MARK) > 0, new) > 0
    hit = np.repeat((size > 1) & block, size)
    piece, place = piece[hit], (place[hit] & ~_MARK).astype(np.int64)
    order = np.argsort(piece, kind="stable")
    piece, place = piece[order], place[order]
    out = []
    chunks = group["chunk"].to_numpy()
    for i in np.unique(piece):
        a, b = np.searchsorted(piece, [i, i + 1])
        flags = np.zeros(place[a:b].max() + 1, dtype=bool)
        flags[place[a:b]] = True
        out.append((chunks[i], _bits(flags)))
    return pd.DataFrame(out, columns=["chunk", "data"])


def _either(group: pd.DataFrame) -> pd.DataFrame:
    """The union of a chunk's bits."""
    width = max(len(d) for d in group["data"])
    out = np.zeros(width, dtype=np.uint8)
    for d in group["data"]:
        out[:len(d)] |= np.frombuffer(d, dtype=np.uint8)
    return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "flags": [out.tobytes()]})


def candidates(chunks: DataFrame, bits: int) -> DataFrame:
    """Rows (chunk, flags): a bit per document that shares an anchor with another."""
    met = anchors(chunks, bits).groupBy("bucket").applyInPandas(_meet, "chunk long, data binary")
    return met.groupBy("chunk").applyInPandas(_either, "chunk long, flags binary")


def _windows(hashes: WordHashes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every 50-word window: its 64 bits, and those that choose the bucket."""
    half = windows(hashes.of_bytes(data), BLOCK)
    n = max(0, len(half) - BLOCK)
    a, b = half[:n], half[BLOCK:BLOCK + n]
    value = mix(a * np.uint64(_OTHER) + b)
    return value, mix(a + (b << np.uint64(1)) + np.uint64(1))


def _chunk_windows(data: bytes, n: int, flags: bytes, bits: int, hashes: WordHashes, decompress):
    """Windows of a chunk's candidates, and the distinct ones in the order they are sent.

    Returns the documents, per window its document and its distinct window, and per
    distinct window bucket, hash and smallest id.
    """
    known, keys, texts = _open(data, n, decompress)
    flags = np.unpackbits(np.frombuffer(flags, dtype=np.uint8), count=None)[:n].astype(bool)
    flags = np.concatenate([flags, np.zeros(n - len(flags), dtype=bool)]) & known
    chosen = np.flatnonzero(flags)
    pairs = [_windows(hashes, texts[i]) for i in chosen]
    doc = np.repeat(chosen, [len(p[0]) for p in pairs])
    if not len(doc):
        empty = np.zeros(0, dtype=np.int64)
        return keys, texts, doc, empty, empty, empty.astype(np.uint64), empty
    value, other = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    bucket = _top(other, bits)
    order = np.lexsort((keys[doc], value, bucket))
    v, b = value[order], bucket[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (b[1:] != b[:-1])])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    return keys, texts, doc, which, bucket[first], value[first], keys[doc[first]]


def long_windows(flagged: DataFrame, bits: int) -> DataFrame:
    """Rows (bucket, chunk, data): distinct 50-word hashes of candidates, smallest ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress, decompress = _zstd()
        hashes = WordHashes()
        for batch in batches:
            for number, n, data, flags in zip(batch["chunk"], batch["docs"], batch["data"], batch["flags"]):
                *_, bucket, value, least = _chunk_windows(data, n, flags, bits, hashes, decompress)
                yield pd.DataFrame(
                    [(b, number, d) for b, d in _send(bucket, bits, [value.astype("<u8"), least.astype("<i8")], compress)],
                    columns=["bucket", "chunk", "data"])

    return flagged.select("chunk", "docs", "data", "flags").mapInPandas(
        run, "bucket long, chunk long, data binary")


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """For every piece of a bucket, a bit per entry: whether a smaller id has the window."""
    piece, value, least = _gather(group, ["<u8", "<i8"])
    order = np.lexsort((least, value))
    v = value[order]
    new = np.concatenate([[True], v[1:] != v[:-1]])
    smallest = least[order][new][np.cumsum(new) - 1]
    seen = np.empty(len(order), dtype=bool)
    seen[order] = smallest < least[order]
    edges = np.searchsorted(piece, np.arange(len(group) + 1))
    return pd.DataFrame({
        "chunk": group["chunk"], "bucket": group["bucket"],
        "bits": [_bits(seen[a:b]) for a, b in zip(edges, edges[1:])]})


def _merge_answers(group: pd.DataFrame) -> pd.DataFrame:
    """One row per chunk: its answers in order of the bucket, each with its length."""
    group = group.sort_values("bucket")
    parts = [np.array([b, len(d)], dtype="<i8").tobytes() + d for b, d in zip(group["bucket"], group["bits"])]
    return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "answers": [b"".join(parts)]})


def _marks(answers: bytes | None, bucket: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(bucket), dtype=bool)
    if answers is None:
        return out
    edges, at = np.searchsorted(bucket, np.arange((1 << bits) + 1)), 0
    while at < len(answers):
        b, size = np.frombuffer(answers, dtype="<i8", count=2, offset=at)
        lo, hi = edges[b], edges[b + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(answers, dtype=np.uint8, count=size, offset=at + 16), count=hi - lo)
        at += 16 + int(size)
    return out


RESULT = "key long, n_words long, n_removed long, kept_sha256 string, spans array<bigint>"


def _finish(flagged: DataFrame, bits: int, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, decompress = _zstd()
        hashes = WordHashes()
        for batch in batches:
            for n, data, flags, answers in zip(batch["docs"], batch["data"], batch["flags"], batch["answers"]):
                keys, texts, doc, which, bucket, _, least = _chunk_windows(
                    data, n, flags or b"", bits, hashes, decompress)
                known = _open(data, n, decompress)[0]
                away = _marks(answers, bucket, bits)
                again = away[which] | (least[which] < keys[doc])
                start = np.searchsorted(doc, np.arange(n + 1))
                out = []
                for i, text in enumerate(texts):
                    words, spans, gone = text.split(), [], 0
                    own = np.flatnonzero(again[start[i]:start[i + 1]])
                    if len(own):
                        cuts = np.flatnonzero(np.diff(own) > WINDOW)
                        begin, end = own[np.concatenate([[0], cuts + 1])], own[np.concatenate([cuts, [-1]])] + WINDOW
                        left, at = [], 0
                        for a, b in zip(begin.tolist(), end.tolist()):
                            left += words[at:a]
                            spans += [a, b - a]
                            gone, at = gone + b - a, b
                        left += words[at:]
                    else:
                        left = words
                    rest = b" ".join(left)
                    row = (int(keys[i]) if known[i] else None, len(words), gone, hashlib.sha256(rest).hexdigest(), spans)
                    out.append(row + ((rest.decode("utf-8") if gone else text.decode("utf-8")),) * with_text)
                names = ["key", "n_words", "n_removed", "kept_sha256", "spans", "text"]
                frame = pd.DataFrame(out, columns=names[:5 + with_text])
                frame["key"] = frame["key"].astype("Int64")
                yield frame

    columns = ["docs", "data", "flags", "answers"]
    return flagged.select(*columns).mapInPandas(run, RESULT + (", text string" if with_text else ""))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: key, n_words, n_removed, kept_sha256, ``spans`` (starts and
    lengths of what goes, in words) and, if asked for, ``text`` as it is left.

    A word goes if a window of 50 consecutive words that covers it also starts in a document
    with a smaller key.  All windows are judged on the input.  A null or empty text has no
    word.  Rows that share a key do not remove each other's words; a row with a null key
    neither loses words nor takes them from others.  An empty table gives no rows.

    A changed text is its words joined by single spaces; others stay as they are.
    """
    chunks = kept(pack_chunks(docs, key, text), "chunks")
    total = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = max(0, int(np.ceil(np.log2(max(1.0, total / 6 / BUCKET_WORDS)))))
    flags = kept(candidates(chunks, bits), "candidates")
    # Spark broadcasts the flags where their file is small, and shuffles chunks else.
    found = long_windows(chunks.join(flags, "chunk"), bits)
    answers = found.groupBy("bucket").applyInPandas(_answer, "chunk long, bucket long, bits binary")
    answers = kept(answers.groupBy("chunk").applyInPandas(_merge_answers, "chunk long, answers binary"), "answers")
    marked = chunks.join(flags, "chunk", "left").join(answers, "chunk", "left")
    return _finish(marked, bits, with_text).withColumnRenamed("key", key)
