"""Token ids by a public byte-level BPE file.

tiktoken encodes, with the file's own vocabulary as ranks, if the file's merges stand in the order of
their ids and it has no other normalizer, pre-tokenizer or option than plain byte-level files; else, and for texts that hold the file's special tokens, the tokenizers library does. Ids
always equal those of the tokenizers library.
"""

from __future__ import annotations

import json
import sys
from array import array
from functools import lru_cache

#: A fixed value of byte-level BPE files: the pre-token rule.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable character that byte-level files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _fast(path: str):
    """tiktoken's encoder for the file, or None where its merges aren't in the order of ids."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    if not plain_byte_level(whole):
        return None
    model = whole["model"]
    vocab, byte_of = model["vocab"], _byte_of()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [vocab["".join(m)] for m in merges]
    if order != sorted(order):
        return None
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if all(c in byte_of for c in token) and i < len(merges) + 256}
    return tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def plain_byte_level(file: dict) -> bool:
    """Whether a tokenizer file is byte-level BPE with the one pre-token rule that PRE_TOKEN states, and nothing besides."""
    steps, model = file.get("pre_tokenizer") or {}, file["model"]
    parts = steps.get("pretokenizers", [steps])
    rule = len(parts) == 1 and parts[0].get("type") == "ByteLevel" and not parts[0].get("add_prefix_space", True) and parts[0].get("use_regex", True)
    odd = model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("byte_fallback") or model.get("ignore_merges")
    return bool(rule) and file.get("normalizer") is None and model.get("type", "BPE") == "BPE" and not odd


class Encoder:
    """encode(text) gives the ids, little-endian unsigned 32 bits each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast, self._lengths = _fast(path), None
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def byte_lengths(self):
        """The length in bytes of each id's text, as an array."""
        if self._lengths is None:
            import numpy as np

            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self._lengths = np.zeros(max(vocab.values()) + 1, np.int64)
            for token, i in vocab.items():  # byte-level files write one character for each byte
                self._lengths[i] = len(token.encode()) if token in self.specials else len(token)
        return self._lengths

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if not text or self.fast is None or any(s in text for s in self.specials):
            ids = self.slow(text)
        else:
            ids = self.fast(text)
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
