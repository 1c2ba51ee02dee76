"""Ids and bytes of the public tokenizers' tokens; files are named by parameters."""

from __future__ import annotations

import base64
import re

import numpy as np

# A longer run of white space overflows the stack of tiktoken's pattern matcher.
LONG_RUN = 100_000
_LONG_RUN = re.compile(r"\s{%d}" % LONG_RUN)


class ByteIds:
    """Byte-level BPE of ``byte_bpe_50k.json``; special strings in a text are ordinary text.

    Ids come from the rank file of the same vocabulary at twice the speed; texts with a very
    long run of white space go to ``tokenizers``, which gives the same ids without recursion.
    """

    def __init__(self, ranks_file: str | None = None, json_file: str | None = None):
        import public_tokenizers
        import tiktoken

        self.json_file = json_file or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = None

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and _LONG_RUN.search(text):
            if self.plain is None:
                from tokenizers import Tokenizer

                self.plain = Tokenizer.from_file(self.json_file)
                self.plain.encode_special_tokens = True
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def encode_ordinary(self, text: str) -> list[int]:
        return self.ids(text).tolist()


class PieceIds:
    """Sentence pieces of ``piece_bpe_32k.model``, which puts a space before the text."""

    def __init__(self, model_file: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file or public_tokenizers.path("piece_bpe_32k.model"))
        n = self.model.get_piece_size()
        self.tokens = [self._bytes(i) for i in range(n)]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(own, np.int64) for own in self.model.encode(texts, num_threads=1)]
