"""Token counts of whole texts by a public library's encoder, in Arrow batches that return lengths only.

Batches are balanced by bytes, and long texts are cut where no token can span the cut and neither side changes the
other's tokens, so a task's memory follows the batch size and not the longest text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, map_text

#: Before white space between two ASCII letters or digits, or between an ideographic comma or full stop and an ideograph:
#: white space and punctuation end a word for every word splitter that splits() accepts, and no character composes across.
CUT = re.compile(r"(?<=[0-9A-Za-z])(?=[ \t\n\r][0-9A-Za-z])|(?<=[、。，])(?=[一-鿿])")
#: For pieces that carry their own word mark: at a single blank, which is left out as each chunk gets a mark of its own.
BLANK = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

_loaded: dict[tuple[str, bytes], Counter] = {}


class Counter:
    """Counts tokens of texts with one loaded vocabulary; special tokens are not added, the text's own special strings are as the library has it."""

    def __init__(self, kind: str, data: bytes):
        self.chunk_chars = 1 << 14
        self.cut: re.Pattern | None = None
        self.skip = 0
        if kind == "json":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(data.decode())
            own.no_truncation()
            own.no_padding()
            self.lengths: Callable[[list[str]], list[int]] = lambda texts: [len(e) for e in own.encode_batch_fast(texts, add_special_tokens=False)]
            if splits(own):
                self.cut = CUT
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=data)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            if not any("▁" in p.lstrip("▁") for p in pieces) and model.encode("a", out_type=str)[0].startswith("▁"):
                self.cut, self.skip = BLANK, 1

    def chunks(self, text: str) -> list[str]:
        """The text in chunks of at least chunk_chars that have as many tokens together; a text without a safe cut stays whole."""
        if self.cut is None or len(text) <= self.chunk_chars:
            return [text]
        out, at = [], 0
        while len(text) - at > self.chunk_chars and (m := self.cut.search(text, at + self.chunk_chars)):
            out.append(text[at : m.start()])
            at = m.start() + self.skip
        return [*out, text[at:]]

    def counts(self, texts: list[str], batch_chars: int = 1 << 17) -> np.ndarray:
        """Tokens of each text, encoded in batches of about `batch_chars`."""
        total = np.zeros(len(texts), np.int64)
        batch: list[str] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            np.add.at(total, owner, self.lengths(batch))
            batch.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for chunk in self.chunks(text):
                if batch and size + len(chunk) > batch_chars:
                    flush()
                    size = 0
                batch.append(chunk)
                owner.append(i)
                size += len(chunk)
        if batch:
            flush()
        return total


def splits(tokenizer) -> bool:
    """Whether words end at white space and between punctuation and letters, so that cuts there are safe: byte-level splitting by its usual
    pattern, or a pattern that keeps letters and other signs apart, and special tokens without white space."""
    import json

    spec = json.loads(tokenizer.to_str())
    steps = spec["pre_tokenizer"] or {}
    steps = steps.get("pretokenizers", [steps])
    usual = any(s.get("type") == "ByteLevel" and s.get("use_regex", True) and not s.get("add_prefix_space") for s in steps)
    apart = any(s.get("type") == "Split" and s.get("invert") and r"[^\s\p{L}\p{N}]+" in s.get("pattern", {}).get("Regex", "") for s in steps)
    norm = spec["normalizer"] or {}
    known = all(n.get("type") in ("NFC", "NFKC", "Lowercase", "Replace", None) for n in norm.get("normalizers", [norm]))
    return (usual or apart) and known and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])


def load(kind: str, data: bytes) -> Counter:
    """One counter a Python worker and vocabulary."""
    key = (kind, hashlib.sha256(data).digest())
    if key not in _loaded:
        _loaded[key] = Counter(kind, data)
    return _loaded[key]


def count_tokens(docs: DataFrame, vocabulary: str, *, text: str = "text", keep: list[str] | None = None, most_bytes: int = 1 << 20) -> DataFrame:
    """Columns `keep` (default: all) with n_bytes (UTF-8) and n_tokens of each whole text.

    `vocabulary` is the path of a `tokenizers` file (.json) or of a `sentencepiece` model (.model); the driver reads it and sends
    its bytes, some megabytes of fixed size, to the tasks. A null or empty text has 0 bytes and 0 tokens. Very long texts are
    encoded in chunks; only a run without any safe cut is encoded in one. Repeated rows are counted each, an empty table stays
    empty, and a kept column called n_bytes or n_tokens is replaced.
    """
    kind = {".json": "json", ".model": "model"}[Path(vocabulary).suffix]
    sent = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def make() -> Callable[[Texts], list[pa.Array]]:
        counter = load(kind, sent.value)

        def of(texts: Texts) -> list[pa.Array]:
            strings = [texts.bytes(i).decode("utf-8", "replace") for i in range(texts.n)]
            return [pa.array(texts.lengths, pa.int64()), pa.array(counter.counts(strings), pa.int64())]

        return of

    return map_text(docs, text, make, [("n_bytes", "long"), ("n_tokens", "long")], keep=keep, most_bytes=most_bytes)


def over(limit: int) -> Column:
    return F.col("n_tokens") > limit
