"""Token ids of whole texts under a byte-level BPE vocabulary file (a ``tokenizers`` JSON).

The vocabulary is read once on the driver (its path is a parameter) and sent to the tasks in a
broadcast of fixed size: the file, 1.5 MB.  ``Encoder`` gives the ids of the ``tokenizers``
library with ``add_special_tokens=False`` and its defaults otherwise: an added token's string in a text
is that token.  That library encodes about 2 MB a second and core, so
texts whose characters all lie below U+0240 go through ``tiktoken`` with the same vocabulary
(in byte-level BPE a token's id is its merge rank), which gives the same ids five times as
fast; in that range both splitting patterns see the same letters, digits and spaces.  All other
texts, and those that hold an added token's string, take ``tokenizers`` itself, whose Unicode tables may differ for later scripts.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: First UTF-8 byte of U+0240; later characters have this lead byte or a larger one.
_LIMIT = 0xC9


def read_vocabulary(path: str = BYTE_BPE) -> str:
    """The vocabulary file's content (driver side)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts, and the bytes each id stands for."""

    def __init__(self, vocabulary: str):
        import tiktoken

        letters = byte_alphabet()
        spec = json.loads(vocabulary)
        added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(letters[c] for c in s): i for s, i in vocab.items() if i not in added}
        self.size = max([*vocab.values(), *added]) + 1
        self.lengths = np.zeros(self.size, np.int64)
        for s, i in [*ranks.items(), *((text, i) for i, text in added.items())]:
            self.lengths[i] = len(s)
        self._added = list(added.values())
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self._vocabulary, self._exact = vocabulary, None

    def ids(self, raw: np.ndarray) -> np.ndarray:
        """Token ids of one text, given as its UTF-8 bytes."""
        if not len(raw):
            return np.zeros(0, np.int64)
        data = raw.tobytes()
        if raw.max() < _LIMIT and not any(x in data for x in self._added):
            return np.asarray(self._fast.encode_ordinary(data.decode()), np.int64)
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_str(self._vocabulary)
        return np.asarray(self._exact.encode(data.decode(), add_special_tokens=False).ids, np.int64)


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(vocabulary)
