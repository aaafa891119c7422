"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a slice of texts lie in one ragged array of byte symbols. Each round finds every sequence's
lowest-rank pair and merges it in all sequences at once, until no pair of any sequence is in the merge list; what is
left is counted. Counts of pre-tokens seen before are kept in a table of bounded size per worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import pretokens
from tidemill.llm.shared import in_arrow, pick, text_slices

NEVER = np.int64(2**40)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else 256, 257, ..."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merges:
    """A byte-level vocabulary file as arrays: the symbol of each byte, and rank and result of each mergeable pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind.get("use_regex", True):
            raise ValueError("only byte-level vocabularies without normalizer and prefix blank")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take blanks or whole words only are not supported")
        vocab, pairs = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in pairs]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.first = np.array([vocab[s] for s in byte_symbols()], np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], NEVER)

    def lengths(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols left of each byte sequence (none empty) after all merges."""
        size = np.array([len(s) for s in sequences], np.int64)
        out, which = size.copy(), np.arange(len(sequences))
        symbols = self.first[np.frombuffer(b"".join(sequences), np.uint8)]
        starts = np.cumsum(size) - size
        ranks = np.full(len(symbols), NEVER)
        ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
        ranks[starts[1:] - 1] = NEVER
        while len(which):
            lowest = np.minimum.reduceat(ranks, starts)
            open_ = lowest < NEVER
            if not open_.all():  # sequences without a pair are done
                out[which[~open_]] = size[~open_]
                if not open_.any():
                    break
                stay = np.repeat(open_, size)
                symbols, ranks = symbols[stay], ranks[stay]
                which, size, lowest = which[open_], size[open_], lowest[open_]
                starts = np.cumsum(size) - size
            found = np.flatnonzero(ranks == np.repeat(lowest, size))
            fresh = np.ones(len(found), bool)
            fresh[1:] = found[1:] != found[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(found)), 0))
            found = found[(np.arange(len(found)) - run) % 2 == 0]  # of overlapping pairs every other one, from the left
            symbols[found] = self.result[ranks[found]]
            left = np.ones(len(symbols), bool)
            left[found + 1] = False
            place = np.cumsum(left) - 1
            changed = place[found]
            gone = np.add.reduceat(~left, starts)
            symbols, ranks, size = symbols[left], ranks[left], size - gone
            starts = np.cumsum(size) - size
            last = np.zeros(len(symbols) + 1, bool)
            last[starts + size - 1] = True
            ranks[changed] = NEVER
            for at in (changed[~last[changed]], (changed - 1)[(changed > 0) & ~last[changed - 1]]):
                ranks[at] = self.ranks(symbols[at], symbols[at + 1])
        return out


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, known = Merges(path), pretokens.Known()
        for batch in text_slices(batches, "text", 500_000):
            texts = batch.column(1)
            found = pretokens.split(texts.to_pylist(), merges.specials)
            hashes, at, back = pretokens.distinct(found.hashes)
            lengths = known.get(hashes)
            lengths[(lengths < 0) & (found.special[at] > 0)] = 1
            new = np.flatnonzero(lengths < 0)
            if len(new):
                spans = zip(found.starts[at[new]].tolist(), found.ends[at[new]].tolist())
                lengths[new] = merges.lengths([found.joined[a:b].encode("utf-8") for a, b in spans])
                known.put(hashes[new], lengths[new])
                if known.full:
                    known.clear()
            counts = np.zeros(len(texts), np.int64)
            if len(back):
                counts = np.bincount(found.owner, weights=lengths[back], minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Every row gives one row, repeated rows too, in any order; a NULL id stays NULL; a NULL text counts as empty (0, 0);
    whole texts are counted, of any length, in slices of bounded memory; an empty table gives no rows; other columns,
    whatever their names, are not read. The vocabulary file must be readable at ``tokenizer_path`` on every executor.
    """
    over: Column = F.col("n_tokens") > limit
    source = pick(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return in_arrow(source, _counted(tokenizer_path), f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", over)
