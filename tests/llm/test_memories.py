"""What workers remember."""

import numpy as np

from orderlake.llm import corpus, lm_scoring, packing


def test_ascii_words_get_the_ids_of_the_whole_tokenizer():
    encoder = packing.TextEncoder(packing.TOKENIZER)
    assert encoder.runs.letters is not encoder.encode
    for text in ("The quick brownish fox", "Tom's ZZtop, it's ll 'll don. abc123", "naïve ÉCOLE x" + "y" * 200):
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == encoder.encode(text)


def test_a_lasting_memory_ends_with_the_next_operator():
    mine, other = {"a": 1}, {"b": 2}
    corpus.lasting_memory("test-mine", mine)
    corpus.lasting_memory("test-other", other)
    corpus.free_memories("test-mine")
    assert (mine, other) == ({"a": 1}, {})
    corpus.free_memories()
    assert mine == {}


def test_subword_ids_are_those_of_the_whole_tokenizer():
    ids, asked = lm_scoring.SubwordIds(lm_scoring.TOKENIZER), []
    encoded = ids.encoded
    ids.encoded = lambda text: asked.append(text) or encoded(text)
    for word in ("brownish", "ciónrañ", "Étion!!", "x" * 200 + "***", "onley.", "abc?!", "straße,"):
        assert np.frombuffer(ids[word.encode()], "<u2").tolist() == encoded(word)
    assert ids.direct and asked == ["!!", "***", ".", "?!", ","]
    for word in ("it's", "we'll.", "<|endoftext|>", "a<|endoftext|>.", "İa", "é!", "ǅ", "7a.", "中.", "a|>"):
        assert np.frombuffer(ids[word.encode()], "<u2").tolist() == encoded(word)


def test_the_memory_of_subwords_lasts_while_texts_are_written_in_them():
    ids = lm_scoring.subwords()
    ids[b"lasting"]
    corpus.free_memories(lm_scoring.MEMORY)
    assert b"lasting" in ids
    corpus.free_memories()
    assert not ids
