"""op8 where texts hold the tokenizer's added tokens in any case."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from scanpress.llm import tokenids

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_added_tokens_match_as_written():
    texts = [
        "Hello <|ENDOFTEXT|> World",
        "a<|EndOfText|>B, c<|endoftext|>D.",
        "<|STARTOFTEXT|><|startoftext|>X <|startoftext|>X <|StartOfText|>x",
        "<|endoftext|> <|ENDOFTEXT|>, <|endoftext|>,",
        "Plain Words <|END OFTEXT|> <|endoftext|",
    ]
    library = Tokenizer.from_file(TOKENIZER)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for order in (1, -1):  # whichever case the cache learns first
        ids = list(tokenids.ChunkEncoder(TOKENIZER).encode(texts[::order]))
        assert [np.frombuffer(i, "<u4").tolist() for i in ids] == want[::order]
