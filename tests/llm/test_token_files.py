"""Token ids and their files against the tokenizer itself, in exact round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm.token_files import (
    Block,
    Model,
    decode_steps,
    encode_ids,
    load_model,
    pack_block,
    read_token_files,
    token_file_report,
    write_token_files,
)
from wattloom.llm.tokens import Encoder, default_path
from wattloom.session import scratch_dir


def reference_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_path())
    return [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


WORDS = ["the", "The,", "THE.", "it's.", "we'll,", "é.", "É,", "İ.", "Σ,", "a***", "b$$$", "c!!", "d'.", "<|endoftext|>.", "x<|", "x1.", "ẞ,", "ÀÉÎ", "ŒUVRE,", "ſ.", "ŉ", "Ñandú-", "ß.", "e\u0301.", "ﬁ,", "Ǆ.", "字,", "a.b,", "'ll.", "K."]


@given(st.lists(st.sampled_from(WORDS), max_size=12).flatmap(lambda w: st.sampled_from([" ".join(w), "".join(w), "\n".join(w)])))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_text(text):
    assert np.frombuffer(Encoder.of(default_path()).encode([text.encode()])[0], "<u2").tolist() == reference_ids(text)


@given(st.text(alphabet=st.sampled_from("aBé'st ll\n\t\x0b́  Σσς1２#<|>endoftxrg🙂İ字"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_give_the_ids_of_the_text(text):
    assert np.frombuffer(Encoder.of(default_path()).encode([text.encode()])[0], "<u2").tolist() == reference_ids(text)


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Hello  there,\n world. "
    ids = np.frombuffer(Encoder.of(path).encode([text.encode()])[0], "<u2").tolist()
    assert not Encoder.of(path).by_words and Encoder.of(default_path()).by_words
    assert ids == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]


def test_special_strings_full_caches_and_long_texts(monkeypatch):
    monkeypatch.setattr("wattloom.llm.tokens.CACHED", dict.fromkeys(("words", "others"), 700))
    monkeypatch.setattr("wattloom.llm.tokens._STRETCH", 20)
    encoder = Encoder(default_path())
    texts = ["one two three four five", "<|endoftext|>a b<|startoftext|> c", "two six one", "", "Größe, "  * 30 + "x" * 50 + "\n\x0b end."]
    data = [text.encode() for text in texts]
    for text, ids in zip([texts[3], texts[4], *texts, *texts], encoder.encode(data[3:]) + encoder.encode(data) + encoder.encode(data), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == reference_ids(text)
    assert len(encoder.words.young) + len(encoder.words.old) <= 8 and len(encoder.others.young) + len(encoder.others.old) <= 8
    assert encoder.encode([]) == []


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 140_000])
def test_coding_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    model = Model.fit(np.bincount(ids))
    block = Block(pack_block([(7, ids[: n // 2]), (None, ids[n // 2 :])], model))
    assert np.array_equal(block.ids(model), ids)
    last = len(block.places) - 1
    assert np.array_equal(block.part(last, model), ids[last * block.every * block.lanes :])
    assert block.lengths.tolist() == [n // 2, n - n // 2] and block.nulls.tolist() == [0, 1]


def test_one_symbol_costs_almost_nothing():
    ids = np.zeros(100_000, np.uint32)
    words, places, states = encode_ids(ids, Model.fit(np.array([5])))
    assert len(words) == 0 and len(decode_steps(len(ids), 1024, 0, 98, words, 0, states[0], Model.fit(np.array([5])))[0]) == 100_000


def test_damage_is_found():
    ids = np.arange(3000, dtype=np.uint32)
    model = Model.fit(np.bincount(ids))
    data = bytearray(pack_block([(1, ids)], model))
    data[-3] ^= 1
    with pytest.raises(ValueError):
        Block(bytes(data)).ids(model)


def test_report_matches_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr("wattloom.llm.token_files.BLOCK_TOKENS", 50)
    rows = [(5, "Some words here", "x"), (None, "no id", "y"), (3, None, "z"), (9, "", "x"), (7, "again " * 400, "x"), (5, "Some words here", "x"), (8, "ünï 💡", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = token_file_report(docs).collect()
    expected, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(reference_ids(text or ""), "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert token_file_report(docs.limit(0)).collect() == []


def test_a_folder_is_read_alone(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (4, "ünï 💡 " * 50)], "doc_id long, text string")
    folder = scratch_dir(spark, "alone")
    write_token_files(docs, folder, default_path())
    found = read_token_files(spark.newSession(), folder).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in found] == [len(reference_ids(t or "")) for _, t in docs.collect()]
    freq = load_model(spark, folder).freq
    assert freq.sum() == 1 << 20
    broken = scratch_dir(spark, "broken")
    spark.createDataFrame([(b"other bytes!", 1)], "freq binary, crc bigint").write.parquet(f"{broken}/table")
    with pytest.raises(ValueError):
        load_model(spark, broken)
