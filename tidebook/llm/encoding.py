"""Token ids of texts under one of the public vocabularies, inside tasks.

The vocabulary's own library decides what is right. For the byte-level vocabulary that is also
there as ranks, ordinary texts take the rank library, which is several times faster and merges
alike; texts that hold the special token, or an unbroken run long enough to be slow there, go to
the vocabulary's own library.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache
from hashlib import sha256

import public_tokenizers

#: Runs of at least so many characters without (or of) white space are merged by the library that
#: needs no time square in their length.
LONG_RUN = 2000
_UNUSUAL = re.compile(r"\S{%d}|\s{%d}|<\|endoftext\|>" % (LONG_RUN, LONG_RUN))


@cache
def version(name: str) -> str:
    """Digest of a vocabulary file: another file is another version."""
    with open(public_tokenizers.path(name), "rb") as f:
        return sha256(f.read()).hexdigest()[:16]


@cache
def _own(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return lambda texts: model.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path(name))
    model.no_truncation()
    model.no_padding()
    return lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


@cache
def _ranks(name: str):
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
    return tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(name: str, texts: list[str]) -> list[list[int]]:
    """Ids of each text as the library for ``name`` gives them, without added special tokens."""
    if name.endswith(".tiktoken"):
        return [_ranks(name).encode_ordinary(t) for t in texts]
    if name != "byte_bpe_50k.json":
        return _own(name)(texts)
    fast = _ranks("byte_bpe_50k.tiktoken").encode_ordinary
    return [_own(name)([t])[0] if _UNUSUAL.search(t) else fast(t) for t in texts]
