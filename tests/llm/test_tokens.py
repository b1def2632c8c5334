"""SentencePiece segmentation and the token files against the libraries and plain Python."""

import itertools
import math
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftable.llm import pieces, tokenbin

PIECES, BYTES = (public_tokenizers.path(f) for f in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
MODELS = {kind: pieces.Pieces(PIECES, kind) for kind in ("zipf", "model")}
TEXT = st.text(alphabet=st.sampled_from("  aehinrst.,\n▁éß梦😀\x00Ü1T\t"), max_size=40)


def split(ids_and_sizes):
    ids, sizes = ids_and_sizes
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def plain_viterbi(model, word, table):
    """Best segmentation character by character, scores as 32-bit numbers, ties to the longer last piece."""
    best, back = [np.float32(0)], [None]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(max(0, end - model.longest), end):
            if word[start:end] in table:
                i, score = table[word[start:end]]
                options.append((np.float32(best[start] + score), start, [i]))
            elif start == end - 1:
                raw = word[start:end].encode()
                options.append((np.float32(best[start] + model.unknown), start, [int(model.byte[b]) for b in raw]))
        top = max(o[0] for o in options)
        score, start, ids = next(o for o in options if o[0] == top)
        best.append(score)
        back.append((start, ids))
    out, end = [], len(word)
    while end:
        end, ids = back[end]
        out = ids + out
    return out


@pytest.mark.parametrize("kind", MODELS)
def test_words_against_plain_search(kind):
    model = MODELS[kind]
    score = {int(i): s for i, s in zip(model.ids, model.scores, strict=True)}
    table = {model.text[i]: (i, s) for i, s in score.items()}
    rng = random.Random(5)
    letters = "thereionsa▁éßxqz梦" + "▁"
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 24))) for _ in range(300)] + ["▁Hello", "▁" * 40, "ab" * 300]
    assert split(model.encode_words(words)) == [plain_viterbi(model, w, table) for w in words]


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def read_varint(data, i):
    n = shift = 0
    while True:
        n |= (data[i] & 127) << shift
        shift += 7
        i += 1
        if data[i - 1] < 128:
            return n, i


def fields(data):
    i = 0
    while i < len(data):
        tag, i = read_varint(data, i)
        if tag & 7 == 0:
            start = i
            value, i = read_varint(data, i)
            yield tag >> 3, 0, value, start
        else:
            size, start = (4, i) if tag & 7 == 5 else read_varint(data, i)
            yield tag >> 3, tag & 7, data[start : start + size], start
            i = start + size


def as_unigram(kind):
    """The same pieces as a unigram model of the library, with the scores that are searched here."""
    out = b""
    for number, wire, value, _ in fields(open(PIECES, "rb").read()):
        if number == 1:
            parts = {n: v for n, _, v, _ in fields(value)}
            score = struct.unpack("<f", parts[2])[0]
            if kind == "zipf" and 3 not in parts:
                score = -math.log1p(-score)
            value = b"\x0a" + varint(len(parts[1])) + parts[1] + b"\x15" + struct.pack("<f", score)
            value += b"\x18" + varint(parts[3]) if 3 in parts else b""
        elif number == 2:
            at = next(start for n, _, _, start in fields(value) if n == 3)
            value = value[:at] + b"\x01" + value[at + 1 :]
        out += varint(number << 3 | wire) + varint(len(value)) + value
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.mark.parametrize("kind", MODELS)
def test_words_against_the_library(kind):
    library = as_unigram(kind)
    rng = random.Random(6)
    words = ["▁" + "".join(rng.choices("thereionsaéßxqz梦😀", k=rng.randrange(1, 16))) for _ in range(3000)]
    found, known = split(MODELS[kind].encode_words(words)), [library.encode(w[1:]) for w in words]
    if kind == "zipf":
        assert found == known
    score = lambda ids: sum(library.get_score(i) for i in ids)  # noqa: E731  # unknown characters cost so much that 32 bits do not tell small differences
    assert all(a == b or score(a) >= score(b) - 128 for a, b in zip(found, known, strict=True))
    assert sum(a == b for a, b in zip(found, known, strict=True)) > 0.98 * len(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_round_trip(texts):
    model = MODELS["zipf"]
    encoder = pieces.ChunkEncoder(model.encode_words, most=3)
    for _ in range(2):
        ids = encoder.ids([pieces.chunks(t) for t in texts])
        assert model.decode(ids) == [t.replace("▁", " ") for t in texts]
        whole = [split(model.encode_words([pieces.SPACE + t.replace(" ", pieces.SPACE)]))[0] if t else [] for t in texts]
        assert [x.tolist() for x in ids] == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"  \n\taZ's!1é\xa0\x1c　\r", "<|endoftext|>"]), max_size=20).map("".join), max_size=4))
def test_chunks_give_the_ids_of_whole_texts(texts):
    plain = Tokenizer.from_file(BYTES)
    encoder = tokenbin._encoder(BYTES)
    assert [x.tolist() for x in encoder(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("doc_id", F.col("doc_id") * 7 - 100)
    folder = str(tmp_path_factory.mktemp("tokens") / "out")
    tokenbin.write(docs, folder, BYTES)
    plain = Tokenizer.from_file(BYTES)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    return folder, [(k, [*plain.encode(t, add_special_tokens=False).ids, 0]) for k, t in rows]


def test_files_hold_all_ids_in_order(spark, written):
    import zlib

    folder, expected = written
    found = {int(r.key): (r.start, r.n_tokens, r.ids_crc32) for r in tokenbin.read(spark, folder).collect()}
    start = 0
    for key, ids in expected:
        assert found[key] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(expected)


def test_single_documents_are_read_by_the_index(spark, written):
    folder, expected = written
    some = dict(expected[3::50])
    assert {int(k): v for k, v in tokenbin.read_documents(spark, folder, list(some)).items()} == some


def test_dictionary_is_used_and_checked(spark, written):
    folder, _ = written
    row = spark.read.parquet(f"{folder}/dictionary").first()
    assert len(row.data) > 0 and {r[0] for r in spark.read.parquet(f"{folder}/blocks").select("dictionary").collect()} == {row.hash}
    shards = spark.read.parquet(f"{folder}/blocks").select("shard", "block", "ids").collect()
    ids = [int(i) for s in sorted(shards, key=lambda s: (s.shard, s.block)) for i in s.ids]
    assert ids == sorted(ids)


def test_long_words_like_short_ones(monkeypatch):
    model = pieces.Pieces(PIECES)
    random = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz  ,.éß梦😀01")
    words = ["".join(random.choice(letters, size=n)).replace(" ", "e") for n in (2, 17, 40, 90, 256)] + ["a" * 200, "\x01" * 50]
    plain = [model._viterbi([w], len(w))[0].tolist() for w in words]
    assert [model._viterbi_long(w).tolist() for w in words] == plain
    monkeypatch.setattr(pieces, "PLACES", 7)
    assert [model._viterbi_long(w).tolist() for w in words] == plain
    monkeypatch.setattr(pieces, "LONG", 30)
    flat, counts = model.encode_words(words)
    cuts = np.cumsum(counts)
    assert [flat[b - c : b].tolist() for b, c in zip(cuts, counts)] == plain


def test_a_text_without_spaces(spark):
    import time

    text = ("thequickbrownfoxjumpsoverthelazydog梦x9" * 30_000)[: 1 << 20]
    model = pieces.Pieces(PIECES)
    started = time.process_time()
    ids = model._viterbi_long("▁" + text)
    assert time.process_time() - started < 60
    assert model.decode([ids])[0] == text


TRICKY = [
    "Hello, world. Next\nline,\nand more.\n", "a, b. c", ", x", ". x", "x , y", "x.. y", "x., y", "9. 8, 7.\n6", "_, a_. b", "it's, don't. he'll\n's", "\nfirst",
    "x\n", "\n", "a\n\nb", "a \nb", "a\n b", "été, mañana. Straße\nüber,\nßx.\n", "日本, 語。 x", "a\u0301, b", "\x02, a", "x\x05 y", "(a), b", '"a." b', "a,b. c,", "word\n'tis, x", "。, a",
    "², ½. x", "a.\n.b", "<|endoftext|>, a", "x,\n,y", "end.", "end, ", " . ", "a\r\nb, c",
]


def test_signs_after_words(monkeypatch):
    encoder = tokenbin._encoder(BYTES)
    whole = [e.ids for e in encoder._tokenizer.encode_batch(TRICKY, add_special_tokens=False)]
    assert [x.tolist() for x in encoder(TRICKY)] == whole
    assert encoder._direct
    monkeypatch.setattr(encoder, "_direct", False)
    assert [x.tolist() for x in tokenbin.Encoder(BYTES)(TRICKY)] == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab,. \n'é2_-ß", max_size=30), min_size=1, max_size=5))
def test_random_signs(texts):
    encoder = tokenbin._encoder(BYTES)
    assert [x.tolist() for x in encoder(texts)] == [e.ids for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_met_again_are_not_encoded_again(monkeypatch):
    """A corpus has several hundred thousand words: the store keeps those, and their ids are the library's."""
    encoder = tokenbin.Encoder(BYTES)
    asked = []
    encode = encoder._chunks._encode
    monkeypatch.setattr(encoder._chunks, "_encode", lambda keys: (asked.append(len(keys)), encode(keys))[1])
    words = ["".join(c) + "é" * (i % 3 == 0) for i, c in enumerate(itertools.islice(itertools.product("abcdefgh", repeat=7), 300_000))]
    texts = [" ".join(words[lo : lo + 10_000]) for lo in range(0, len(words), 10_000)]
    first = [encoder([t])[0] for t in texts]
    again = [encoder([t])[0] for t in texts]
    assert sum(asked) <= len(words) + len(texts)
    assert all(np.array_equal(a, b) for a, b in zip(first, again, strict=True))
    tokenizer = Tokenizer.from_file(BYTES)
    for i in (0, 29):
        assert tokenizer.encode(texts[i], add_special_tokens=False).ids == first[i].tolist()


def test_bytes_of_many_words_at_once():
    words = ["a", " Straße", "日本語", " ", "\x7f", "ÿ", "", "\U0001f600"]
    assert tokenbin._byte_texts(words) == ["a", "ĠStraÃŁe", "æĹ¥æľ¬èªŀ", "Ġ", "ġ", "Ã¿", "", "ðŁĺĢ"]


def test_words_are_looked_up_once_for_many_texts(monkeypatch):
    """The store is asked for the different chunks of some texts, and a sign after a word makes no other chunk of it."""
    encoder = tokenbin.Encoder(BYTES)
    asked = []
    numbers = encoder._chunks._numbers
    monkeypatch.setattr(encoder._chunks, "_numbers", lambda chunks, n: (asked.append(sorted(chunks)), numbers(chunks, n))[1])
    texts = ["Grün, grün. grün; (grün) grün!\nGrün-grün it's", "Grün " * 1000 + "grün"]
    whole = [e.ids for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder(texts)] == whole
    words = ["Grün", " Grün", " grün", " (grün", " it", "'s", "-grün", *",.;)!", "\n"]
    assert asked == [sorted(w.encode() for w in words)]


def test_signs_after_every_letter_of_two_bytes():
    encoder = tokenbin._encoder(BYTES)
    assert encoder._signs
    texts = [f"a{c}.x {c}, {c}{c}'s\n{c}\n({c})-{c}1" for c in map(chr, range(1, 0x800))]
    assert [x.tolist() for x in encoder(texts)] == [e.ids for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_a_tokenizer_that_joins_signs_to_words(tmp_path):
    """Where the probe says that signs are no tokens apart, only white space cuts."""
    from tokenizers import Regex, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.BPE())
    words = pre_tokenizers.Split(Regex(r" ?[^ \n\t]+|[ \n\t]+(?=[ \n\t])|[ \n\t]+"), "isolated")
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([words, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    trainer = trainers.BpeTrainer(vocab_size=400, initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    tokenizer.train_from_iterator(["Hello, world. can't. e.g. i.e. (it's) won't, x,y"] * 20, trainer)
    tokenizer.save(str(tmp_path / "joined.json"))
    encoder = tokenbin.Encoder(str(tmp_path / "joined.json"))
    texts = ["e.g. the i.e. of (it's) x,y", "can't. won't, 3.14", ""]
    assert not encoder._signs
    assert [x.tolist() for x in encoder(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_reading_takes_blocks_as_they_are(spark, written, capsys):
    """One row per block goes to Python, not one per document, for each of which the whole payload would be taken up again."""
    tokenbin.read(spark, written[0]).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "Generate" not in plan
