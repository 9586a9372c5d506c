"""Token ids as the tokenizer file's own library gives them, in bounded memory.

Byte-level BPE files come with the same vocabulary as a rank file, whose library gives the same ids
several times faster. It is used for texts within Latin-1, where both libraries agree on what a
letter or a space is (``tests/llm/test_tokens.py`` compares them); other texts go to the file's library.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np

#: A longer text is encoded in parts.
PART = 1 << 18
#: Where a byte-level file's pattern always begins a new piece: a lone space between two other characters.
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")


def version(path: str) -> str:
    """A digest of the tokenizer's file: counts of another version are never mixed up with it."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def parts(text: str, size: int = PART) -> list[str]:
    """The text cut before lone spaces, where no token spans the cut. Without one it stays whole."""
    out, begin = [], 0
    while len(text) - begin > size:
        cut = _BOUNDARY.search(text, begin + size)
        if cut is None:
            break
        out.append(text[begin : cut.start()])
        begin = cut.start()
    return [*out, text[begin:]]


class Encoder:
    """Ids of whole texts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.ranked = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.slow = lambda text: model.encode(text, num_threads=1)
            self.cuttable = False
            return
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        self.slow = lambda text: model.encode(text, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        pieces = described.get("pre_tokenizer") or {}
        self.cuttable = (
            pieces.get("type") == "ByteLevel"
            and not pieces.get("add_prefix_space")
            and pieces.get("use_regex", True)
            and not described.get("normalizer")
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in described["added_tokens"])
        )
        ranks = path.removesuffix(".json") + ".tiktoken"
        if self.cuttable and os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            special = {t["content"]: t["id"] for t in described["added_tokens"]}
            self.ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special
            )

    def _encode(self, text: str) -> np.ndarray:
        if self.ranked is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.ranked.encode_to_numpy(text, allowed_special="all")
        return np.asarray(self.slow(text), dtype=np.uint32)

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; null is the empty text."""
        if not text:
            return np.zeros(0, np.uint32)
        if not self.cuttable or len(text) <= PART:
            return self._encode(text)
        return np.concatenate([self._encode(part) for part in parts(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)
