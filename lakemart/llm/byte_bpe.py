"""Byte-level BPE from a tokenizer file, run by a faster library with the same ids.

The vocabulary and the added tokens are read from the JSON file of the ``tokenizers`` library and handed to
``tiktoken``, whose ids are the same where merges are ranked by their ids and texts are cut by the usual
pattern of byte-level BPE.  :func:`load` makes sure of the first and refuses files of another kind; equal ids
for every character of Unicode are a test.
"""

from __future__ import annotations

import json

# --- fixed value: the pattern of byte-level BPE that cuts a text into words --------------
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# ----------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def load(path: str):
    """(encoding, bytes of every id): ``encode_ordinary`` takes added tokens' strings as plain text,
    ``encode(..., allowed_special="all")`` gives them their ids, as the file's own library does."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cutter = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or spec["normalizer"] or cutter.get("type") != "ByteLevel"
            or cutter.get("add_prefix_space") or not cutter.get("use_regex", True)):
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()
             if token not in added}
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError(f"merges are not ranked by their ids: {path}")
    raw = [b""] * (max([*ranks.values(), *added.values()]) + 1)
    for token, i in [*ranks.items(), *((t.encode(), i) for t, i in added.items())]:
        raw[i] = token
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens=added), raw
