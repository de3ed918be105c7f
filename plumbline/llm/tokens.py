"""Token ids of a public byte-level BPE vocabulary; its files are given by path and are never copied or trained."""

from __future__ import annotations

import base64
from functools import cache

import numpy as np

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


class Encoder:
    """Ids as tokenizers gives them without special tokens of its own. The same vocabulary as ranks is encoded several
    times faster, and is used where it agrees on a probe; a text that it can't take, or that holds an added token's
    content, falls back."""

    PROBE = "It's 12½ µm\r\n  – naïve\t<|endofte|> 日本語 ​\x1c x_y.z  "

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.added = tuple(t.content for t in self.slow.get_added_tokens_decoder().values())
        self.fast = None
        self.falls = 0  # texts that the fast form couldn't take
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            if fast.encode_ordinary(self.PROBE) == self._plain(self.PROBE):
                self.fast = fast

    def _plain(self, text: str) -> list[int]:
        return self.slow.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(t in text for t in self.added):
            try:
                return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
            except BaseException as e:  # the native library's panics are outside Exception, and known by name only
                if not isinstance(e, (ValueError, RuntimeError)) and type(e).__name__ != "PanicException":
                    raise
                self.falls += 1
        return np.array(self._plain(text), dtype=np.uint32)


@cache
def encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """The encoder of a worker process. Paths are looked up on the machine that encodes."""
    import os

    import public_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if vocabulary is None:
        vocabulary, ranks = public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)
    return Encoder(vocabulary, ranks, public_tokenizers.PATTERN)
