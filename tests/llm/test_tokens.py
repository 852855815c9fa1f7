"""What an encoder remembers changes no ids and is held once."""

import random

import pyarrow as pa

from resultlake.llm import tokens

TEXTS = ["Hello, world!", "", None, "naïve café; (x) --", "don't stop", "!!", "한글 글", "a\nb", "U.S.A. 42 x1y2", "word. Word, WORD"]


def test_generations_change_no_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNKS", 7)
    monkeypatch.setattr(tokens, "TOGETHER", 2)
    rng, encoder = random.Random(3), tokens.ChunkEncoder(tokens.VOCABULARY)
    texts = [rng.choice(TEXTS) for _ in range(200)]
    assert encoder.ids(texts) == [encoder.one(t or "") for t in texts]
    assert encoder.lengths(pa.array(texts)).tolist() == [len(encoder.one(t or "")) // 4 for t in texts]


def test_a_chunk_is_held_once_in_two_generations(monkeypatch):
    """Beside the two generations of numbered chunks no other table of words grows."""
    monkeypatch.setattr(tokens, "CHUNKS", 100)
    monkeypatch.setattr(tokens, "TOGETHER", 1)
    encoder = tokens.ChunkEncoder(tokens.VOCABULARY)
    encoder.ids([f"{chr(97 + i % 26)}{chr(97 + i // 26)}word, other{chr(97 + i % 26)}" for i in range(676)])
    held = [len(v) for v in vars(encoder).values() if isinstance(v, dict)] + [len(encoder.older[0])]
    assert sum(held) <= 2 * (100 + 8)
