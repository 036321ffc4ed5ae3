"""Packing documents into token sequences by lexical retrieval.

Every document becomes token ids. Whole windows of a document stand alone;
the rest of each document is packed with related ones: a seed document looks
up its nearest unused neighbours in a BM25 inverted index of its shard, and
they fill its window greedily, the last one cut to fit.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import id_text, named, slices, write_table

#: The index's terms are token ids (modulo TERMS, for a larger vocabulary), so
#: corpus statistics stay bounded.
TERM_BITS = 18
TERMS = 1 << TERM_BITS
MAX_TF = (1 << (32 - TERM_BITS)) - 1
#: A term of more than this share of a shard's documents is stored as a table row.
DENSE_SHARE = 0.0625
#: Characters whose classes the two tokenizer libraries are known to agree on.
PLAIN = re.compile("[\t\n\r -~¡-¬®-ſ]*\\Z")
TABLE_SCHEMA = "doc_id long, n_tokens long, full array<long>, tail binary, terms binary, sketch long"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids as ``tokenizers`` gives them for the file at ``path``.

    Plain text goes through ``tiktoken`` with the ranks of the same file, which
    is several times faster, provided the file is a byte-level BPE whose ids
    follow its merges; all other text, and text that may hold a special token,
    goes through ``tokenizers``."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._ranks(spec)
        self.kind = np.uint16 if self.slow.get_vocab_size() <= 1 << 16 else np.uint32

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @staticmethod
    def _ranks(spec: dict):
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or spec.get("normalizer") or model.get("byte_fallback") or model.get("continuing_subword_prefix")
                or model.get("end_of_word_suffix")):
            return None
        # The byte alphabet: printable Latin-1 stands for itself, the others follow from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        other = [b for b in range(256) if b not in own]
        byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            return None
        import public_tokenizers
        import tiktoken
        return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and PLAIN.match(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), self.kind)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, self.kind)


def crc(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def term_counts(ids: np.ndarray) -> np.ndarray:
    """A document's terms with their numbers, packed into 32 bits."""
    term, tf = np.unique(ids.astype(np.uint32) & np.uint32(TERMS - 1), return_counts=True)
    return (term | (np.minimum(tf, MAX_TF).astype(np.uint32) << np.uint32(TERM_BITS))).astype("<u4")


def sketch(ids: np.ndarray) -> int:
    """The least hash of a document's pairs of neighbouring tokens."""
    if len(ids) < 2:
        return 0
    pair = ((ids[:-1].astype(np.uint64) << np.uint64(32)) | ids[1:]) * np.uint64(0x9E3779B97F4A7C15)
    pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return int(pair.min() >> np.uint64(1))


def _tokenise(path: str, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.load(path)
        for part in slices(batches):
            out: list[list] = [[] for _ in range(5)]
            for text in named(part, "text").to_pylist():
                own = enc.ids(text)
                ids = np.append(own, enc.kind(0))
                whole = len(ids) // window
                out[0].append(len(ids))
                out[1].append([crc(ids[k * window:(k + 1) * window]) for k in range(whole)])
                out[2].append(ids[whole * window:].tobytes())
                out[3].append(term_counts(own).tobytes())
                out[4].append(sketch(own))
            yield pa.RecordBatch.from_arrays(
                [named(part, "doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.binary()),
                 pa.array(out[3], pa.binary()), pa.array(out[4], pa.int64())],
                ["doc_id", "n_tokens", "full", "tail", "terms", "sketch"])
    return run


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TERMS, np.int64)
    for b in batches:
        for raw in b.column(0).to_pylist():
            total[np.unique(np.frombuffer(raw, "<u4") & np.uint32(TERMS - 1))] += 1
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit])], ["term", "df"])


class Shard:
    """BM25 inverted index over the documents of one shard.

    Terms in more than ``DENSE_SHARE`` of the shard are rows of a table instead,
    which cost less to add up than as postings."""

    def __init__(self, terms: list[bytes], sizes_of: np.ndarray, idf: np.ndarray, mean_size: float,
                 k1: float = 1.2, b: float = 0.75):
        raw = [np.frombuffer(t, "<u4") for t in terms]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.concatenate(raw) if raw else np.zeros(0, np.uint32)
        doc = np.repeat(np.arange(len(raw)), sizes)
        term, tf = (flat & np.uint32(TERMS - 1)).astype(np.int64), (flat >> np.uint32(TERM_BITS)).astype(np.float64)
        norm = k1 * (1 - b + b * sizes_of / max(mean_size, 1e-9))
        weight = idf[term] * tf * (k1 + 1) / (tf + norm[doc])
        _, local = np.unique(term, return_inverse=True)
        # Only terms of two documents of the shard can lead to a neighbour.
        count = np.bincount(local)
        use = count[local] > 1 if len(local) else np.zeros(0, bool)
        doc, local, weight = doc[use], local[use], weight[use]
        often = count > DENSE_SHARE * len(raw)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.table = np.zeros((int(often.sum()), len(raw)))
        dense = often[local]
        self.table[self.row[local[dense]], doc[dense]] = weight[dense]
        # Each document's terms, the weightiest first.
        self.doc_terms = local[np.lexsort((-weight, doc))]
        self.doc_first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(raw)))]).astype(np.int64)
        doc, local, weight = doc[~dense], local[~dense], weight[~dense]
        order = np.argsort(local, kind="stable")
        self.posting_doc, self.posting_weight = doc[order], weight[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(local, minlength=len(count)))]).astype(np.int64)
        self.n = len(raw)

    def scores(self, seed: int, query_terms: int | None = None) -> np.ndarray:
        """BM25 of every document of the shard for the seed's terms: all of
        them, or the ``query_terms`` weightiest."""
        own = self.doc_terms[self.doc_first[seed]:self.doc_first[seed + 1]][:query_terms]
        row = self.row[own]
        own, row = own[row < 0], row[row >= 0]
        size = self.first[own + 1] - self.first[own]
        at = np.repeat(self.first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rare = np.bincount(self.posting_doc[at], weights=self.posting_weight[at], minlength=self.n)
        return rare + self.table[row].sum(0)


def fill(left: np.ndarray, index: Shard, window: int) -> Iterator[list[tuple[int, int]]]:
    """Windows as lists of (document, tokens taken); ``left`` holds the tokens
    that each document has yet to place. The seed is the unused document with
    the most tokens; neighbours follow by score, then by order."""
    order = np.argsort(-left, kind="stable")
    left, at = left.copy(), 0
    while at < len(order):
        seed = order[at]
        if left[seed] == 0:
            at += 1
            continue
        row = [(int(seed), int(min(left[seed], window)))]
        room = window - row[0][1]
        left[seed] -= row[0][1]
        if room:
            score = np.where(left > 0, index.scores(int(seed)), -1.0)
            while room:
                best = int(score.argmax())
                if score[best] < 0:
                    break
                take = int(min(left[best], room))
                row.append((best, take))
                left[best] -= take
                room -= take
                score[best] = -1.0
        yield row


def _pack(path: str, window: int, shard_docs: int, idf, mean_size: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, part, number = Encoder.load(path).kind, TaskContext.get().partitionId(), 0
        weights = idf.value

        def sequences(rows: list[dict]) -> pa.RecordBatch:
            nonlocal number
            out: list[list] = [[] for _ in range(7)]

            def piece(row, start, length, check, seq, offset):
                for c, x in zip(out, (row["doc_id"], start, length, check, row["n_tokens"], seq, offset)):
                    c.append(x)

            tails = [np.frombuffer(r["tail"], kind) for r in rows]
            for r in rows:
                for k, check in enumerate(r["full"]):
                    piece(r, k * window, window, check, (part << 40) | number, 0)
                    number += 1
            index = Shard([r["terms"] for r in rows], np.array([r["n_tokens"] for r in rows], float), weights, mean_size)
            used = np.zeros(len(rows), np.int64)
            for row in fill(np.array([len(t) for t in tails], np.int64), index, window):
                offset = 0
                for d, take in row:
                    ids = tails[d][used[d]:used[d] + take]
                    piece(rows[d], len(rows[d]["full"]) * window + int(used[d]), take, crc(ids), (part << 40) | number, offset)
                    used[d] += take
                    offset += take
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                              ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == shard_docs:
                    yield sequences(held)
                    held = []
        if held:
            yield sequences(held)
    return run


def retrieval_pack(docs: DataFrame, tokenizer: str | None = None, window: int = 1024, id_col: str = "doc_id",
                   text_col: str = "text", shard_docs: int = 2048, shards_per_task: int = 4) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    A document is its ids by ``tokenizer`` (a path), then id 0. Returns one row
    per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. Each id lies in exactly one piece; only the last sequence of a
    shard can be short.

    The terms of BM25 are a document's token ids; document frequencies and the
    mean length come from all documents. A seed asks for all of its terms, and
    frequent ones count with their (small) weight.
    Documents with a common least hash of token pairs (near copies above all) are
    neighbours in the order that shards of ``shard_docs`` are cut from, so a
    seed finds them; equal ones are spread by id and never gather in one task.

    A null or empty text is the id 0 alone. Rows that repeat an id are packed
    one by one, under the same id. Texts of any length are cut into whole
    windows first. No documents: no rows. Other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    rows = id_text(docs, id_col, text_col)
    table = write_table(rows.mapInArrow(_tokenise(path, window), TABLE_SCHEMA), "packing")
    n, tokens = table.agg(F.count("*"), F.sum("n_tokens")).first()
    if not n:
        return docs.sparkSession.createDataFrame([], PIECE_SCHEMA)
    df = np.zeros(TERMS)
    counted = (table.select("terms").mapInArrow(_document_counts, "term long, df long")
               .groupBy("term").agg(F.sum("df").alias("df")).toArrow())  # TERMS rows at most
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    idf = np.where(df > 0, np.log1p((n - df + 0.5) / (df + 0.5)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    tasks = max(1, -(-n // (shard_docs * shards_per_task)))
    order = ["sketch", "doc_id", "n_tokens", "tail"]
    return (table.repartitionByRange(tasks, "sketch", "doc_id", "n_tokens").sortWithinPartitions(*order)
            .mapInArrow(_pack(path, window, shard_docs, shared, tokens / n), PIECE_SCHEMA))
