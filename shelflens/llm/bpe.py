"""A byte-level BPE vocabulary file: merges, byte symbols, special strings, word pattern."""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed value: how byte-level BPE cuts a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the others follow from U+0100 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """What a tokenizers JSON file of a plain byte-level BPE says.

    ``rank`` maps a pair of ids, as ``left * size + right``, to its place in the merge list;
    ``made`` gives the id that a merge makes. Files with a normalizer, a post-processor or
    other settings that change results are refused.
    """

    def __init__(self, content: bytes):
        file = json.loads(content)
        model, cut = file["model"], file["pre_tokenizer"]
        plain = (
            model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
            and file["decoder"]["type"] == "ByteLevel" and not file.get("normalizer")
        )
        added = file["added_tokens"]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("only plain byte-level BPE files are read")
        vocab = model["vocab"]
        characters = byte_characters()
        byte_of = {c: b for b, c in characters.items()}
        self.size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.byte_ids = [vocab[characters[b]] for b in range(256)]
        self.text_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.text_of |= {t["id"]: t["content"].encode() for t in added}
        self.special = {t["content"]: t["id"] for t in added}
        self.pairs, self.rank, self.made = [], {}, []
        for n, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.append((vocab[a], vocab[b]))
            self.rank[vocab[a] * self.size + vocab[b]] = n
            self.made.append(vocab[a + b])
        self.words = regex.compile(WORDS)
        # Of special strings that start at one place, the longest counts.
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if longest else None

    def ids(self, word: str) -> list[int]:
        return [self.byte_ids[b] for b in word.encode()]

    def parts(self, text: str) -> list[tuple[str, bool]]:
        """The text between special strings and these strings themselves, in order."""
        if self.specials is None or not any(s in text for s in self.special):
            return [(text, False)]
        found, at = [], 0
        for m in self.specials.finditer(text):
            found += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        return [*found, (text[at:], False)]


@lru_cache(maxsize=4)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's bytes for all executors: a few MB, whatever the data's size."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())
