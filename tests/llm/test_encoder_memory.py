"""A worker keeps the words of a large vocabulary, in bounded space."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa

from cellscape.llm import encoder, jaccard_join, toxicity


def _words(n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [letters[k % 26] + letters[k // 26 % 26] + letters[k // 676 % 26] + letters[k // 17576 % 26] for k in range(n)]


def test_words_of_a_large_vocabulary_are_encoded_once(monkeypatch):
    own = encoder.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "x " + " ".join(_words(350_000))
    ids = own.encode(text)
    assert not own.later.older and len(own.later) == 350_000
    monkeypatch.setattr(encoder, "REMEMBERED", 2_000)
    few = encoder.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert few.encode(text) == ids and len(few.later) + len(few.later.older) <= 2_000


def test_starts_of_lines_have_a_smaller_memory(monkeypatch):
    monkeypatch.setattr(encoder, "REMEMBERED", 2_000)
    own = encoder.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = _words(3_000)
    assert own.encode("\n".join(words)) == own.direct("\n".join(words))
    assert len(own.first) + len(own.first.older) <= 500


def test_operators_without_an_encoder_free_those_of_the_worker():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "mark": pa.array([0], pa.int32()), "text": ["a b c d e f"]})
    for run in (toxicity.feature_rows, jaccard_join.signatures(5)[0]):
        encoder.encoder(public_tokenizers.path("byte_bpe_50k.json")).encode("some words of a text")
        list(run(iter([batch])))
        assert not encoder._encoders
