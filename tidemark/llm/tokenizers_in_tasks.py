"""Byte-level BPE in tasks: the vocabulary travels as a broadcast file, an encoder is made once
per worker process."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from hashlib import sha256
from pathlib import Path

import numpy as np
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: How byte-level BPE cuts text before it merges bytes (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_MOST_BYTES = 64 << 20
_made: dict[str, object] = {}


def shipped(spark: SparkSession, path: str) -> Broadcast[bytes]:
    """A vocabulary file, read by the driver and sent to every executor; its size is checked."""
    content = Path(path).read_bytes()
    if len(content) > _MOST_BYTES:
        raise ValueError(f"{path} has {len(content)} bytes; a vocabulary has at most {_MOST_BYTES}")
    return spark.sparkContext.broadcast(content)


def once(content: bytes, make: Callable[[bytes], object]):
    """What `make` makes of the file, made once in this process."""
    key = f"{make.__name__}-{sha256(content).hexdigest()}"
    if key not in _made:
        _made[key] = make(content)
    return _made[key]


def rank_encoding(content: bytes) -> tiktoken.Encoding:
    """An encoding from a rank file: a token in base64 and its rank on each line."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[str, int]:
    """The letters in which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def json_encoder(content: bytes) -> Callable[[str], np.ndarray]:
    """Text to ids, by a tokenizer file, special tokens' strings being ordinary text.

    A plain byte-level BPE, whose ids are its merge ranks, runs on the rank encoder: the same ids
    (the tests compare the two) several times faster. Any other goes to the tokenizers library.
    """
    spec = json.loads(content)
    model, added = spec["model"], {a["content"] for a in spec["added_tokens"]}
    plain = (
        model["type"] == "BPE"
        and spec["normalizer"] is None
        and spec["post_processor"] is None
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    )
    if plain:
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        merged = [t.replace(" ", "") if isinstance(t, str) else "".join(t) for t in model["merges"]]
        plain = [model["vocab"][t] for t in merged] == list(range(256, 256 + len(merged)))
    if plain:
        encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: encoding.encode_to_numpy(text, disallowed_special=())
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
