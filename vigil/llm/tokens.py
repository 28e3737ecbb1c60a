"""Vocabulary files and encoders shared by packing and token counting.

A vocabulary is named by a file name of the ``public_tokenizers`` package or by
a path; it is resolved inside the worker, so nothing depends on the driver's
file system.
"""
from __future__ import annotations

import functools
import json
import os

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def resolve(name: str) -> str:
    """Path of a vocabulary: absolute paths as they are, else by package name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def library(name: str):
    """The ``tokenizers`` object of a ``.json`` vocabulary (one per worker)."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(resolve(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.lru_cache(maxsize=4)
def pieces(name: str):
    """The sentencepiece processor of a ``.model`` vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=resolve(name))


def byte_chars() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: the
    printable bytes as themselves, the others as U+0100, U+0101, ... in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in shown):
        out[chr(0x100 + n)] = b
    return out


@functools.lru_cache(maxsize=4)
def encoder(name: str):
    """``text -> numpy uint32 ids`` without begin/end tokens; special strings
    inside a text become their ids, which is the ``tokenizers`` default.

    A plain byte-level BPE (GPT-2 splitting, no normaliser) is run by tiktoken
    with the ranks of the same file: equal ids, about four times faster."""
    path = resolve(name)
    if not path.endswith(".json"):
        sp = pieces(name)
        return lambda text: np.asarray(sp.encode(text), dtype=np.uint32)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model, extra = spec.get("pre_tokenizer") or {}, spec["model"], spec["added_tokens"]
    plain = (spec.get("normalizer") is None and spec.get("post_processor") is None
             and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
             and model["type"] == "BPE" and not model.get("ignore_merges") and not model.get("end_of_word_suffix")
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in extra))
    if not plain:
        tok = library(name)
        return lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    import public_tokenizers
    import tiktoken

    chars, special = byte_chars(), {t["content"]: t["id"] for t in extra}
    ranks = {bytes(chars[c] for c in word): rank for word, rank in model["vocab"].items() if word not in special}
    enc = tiktoken.Encoding("json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.asarray(enc.encode(text, allowed_special="all"), dtype=np.uint32)
