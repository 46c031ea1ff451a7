"""BPE, word pieces and packing against the tokenizers library."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from tokenizers.models import WordPiece

from wattlake.llm import bpe, packing, wordpiece

WILD = "abcdeaeiou thelo'sre<|>é̀ İΣς٣½²Ⅷ日本語🙂 　\x85\x1c\x7f_-!?.,\n\t​́ßŐǅﬁ"


@pytest.fixture(scope="module")
def wild():
    dice = random.Random(1)
    return ["".join(dice.choices(WILD, k=dice.randint(0, 60))) for _ in range(3000)] + [
        "<|startoftext|>x<|endoftext|>", "a" * 3000, "ab" * 2000, "ΑΣ ΑΣΑ", "<|ENDOFTEXT|>", ""]


def test_bpe_equals_the_library(wild, documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(bpe.vocabulary(path))
    for text in wild + [text or "" for text in list(documents.values())[:100]]:
        ids = library.encode(text, add_special_tokens=False).ids
        found = own.encode(text.encode())
        assert np.frombuffer(found, "<u4").tolist() == ids
        assert own.decode(found).decode() == library.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, sf_dir, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {row["doc_id"]: row for row in bpe.op2_bpe(spark, sf_dir).collect()}
    assert set(rows) == set(documents)
    for key in documents:
        ids = library.encode(documents[key] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[key]["n_tokens"] == len(ids)
        assert rows[key]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[key]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_odd_rows(odd, none):
    definition = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = bpe.decode(bpe.encode(odd, definition), definition).collect()
    assert len(rows) == odd.count() and sum(row["n_tokens"] == 0 for row in rows) == 3
    assert bpe.decode(bpe.encode(none, definition), definition).count() == 0


def test_word_pieces_equal_the_library(wild):
    definition = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    begin, continued = wordpiece.piece_sets(definition)
    shown = bpe.byte_alphabet()
    names = ["[UNK]", *sorted("".join(shown[b] for b in piece) for piece in begin),
             *sorted("##" + "".join(shown[b] for b in piece) for piece in continued)]
    library = WordPiece({name: i for i, name in enumerate(dict.fromkeys(names))}, unk_token="[UNK]", max_input_chars_per_word=10**6)
    own = wordpiece.PieceCounter(begin, continued)
    words = {word for text in wild for word in text.encode().split()}
    for word in words:
        assert own.count(word) == len(library.tokenize("".join(shown[b] for b in word))), word


def test_word_pieces_unknown_words():
    own = wordpiece.PieceCounter({b"ab", b"a", b"abcd"}, {b"c", b"b"})
    assert [own.count(word) for word in (b"abc", b"abcd", b"abcb", b"x", b"abx", b"abcc", b"")] == [2, 1, 3, 1, 1, 3, 0]


def test_word_pieces_query(spark, sf_dir, documents):
    begin, continued = wordpiece.piece_sets(bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    longest, known = max(map(len, begin | continued)), {}

    def count(word):
        """Greedy longest match by looking up every slice; a word that cannot be cut up is one token."""
        if word not in known:
            at, pieces = 0, 0
            while at < len(word):
                fits = begin if at == 0 else continued
                stop = next((end for end in range(min(len(word), at + longest), at, -1) if word[at:end] in fits), None)
                if stop is None:
                    pieces, at = 1, len(word)
                    break
                pieces, at = pieces + 1, stop
            known[word] = pieces
        return known[word]

    rows = {row["doc_id"]: row for row in wordpiece.op10_wordpiece(spark, sf_dir).collect()}
    assert set(rows) == set(documents)
    for key, text in documents.items():
        counts = [count(word) for word in (text or "").encode().split()]
        assert (rows[key]["n_words"], rows[key]["n_tokens"], rows[key]["max_word_tokens"]) == \
            (len(counts), sum(counts), max(counts, default=0))


def test_word_pieces_odd_rows(odd, none):
    definition = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    rows = wordpiece.count_pieces(odd, definition).collect()
    assert len(rows) == odd.count() and sum(row["n_words"] == 0 for row in rows) == 3
    assert wordpiece.count_pieces(none, definition).count() == 0


def test_packing(spark, sf_dir, documents, wild):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(packing.ranks_file(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for text in wild:
        assert encoder.encode(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
    rows = packing.op9_packing(spark, sf_dir).toPandas()
    assert set(rows["doc_id"]) == set(documents)
    for key, pieces in rows.sort_values("start").groupby("doc_id"):
        at = 0
        for piece in pieces.itertuples():
            assert piece.start == at
            at += piece.length
        assert at == pieces["doc_tokens"].iloc[0]
    for key in documents:
        ids = np.array([*library.encode(documents[key] or "", add_special_tokens=False).ids, 1], "<u4")
        for piece in rows[rows["doc_id"] == key].itertuples():
            assert zlib.crc32(ids[piece.start:piece.start + piece.length].tobytes()) == piece.ids_crc32
    sizes = rows.groupby("sequence_id")["length"].sum()
    for _, pieces in rows.sort_values("offset").groupby("sequence_id"):
        assert (pieces["offset"].to_numpy() == pieces["length"].cumsum().shift(fill_value=0).to_numpy()).all()
    assert sizes.max() <= 2048 and (sizes < 2048).sum() <= 12
    ordered = rows.sort_values(["sequence_id", "offset"])["curve"].to_numpy()
    assert (ordered[1:] >= ordered[:-1]).all()                   # neighbours on the curve are neighbours in sequences


def test_packing_pads_little_with_many_partitions(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = packing.op9_packing(spark, sf_dir).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = rows.groupby("sequence_id")["length"].sum()
    assert 1 - sizes.sum() / (2048 * len(sizes)) < 0.01
    assert packing.n_ranges(0, 2048, 200) == 1 and packing.n_ranges(10**13, 2048, 200) > 100_000
    assert packing.n_ranges(2 * 10**8, 2048, 200) == 200


def test_packing_wide_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = packing.ranks_file(path)
    assert packing.id_type(ranks) == "<u2"
    wider = ranks.rstrip() + b"\n" + base64.b64encode("\U0001F9ED\U0001F9ED\U0001F9ED".encode()) + b" 70000\n"
    assert packing.id_type(wider) == "<u4"
    rows = packing.pack(spark.createDataFrame([(1, "x")], "doc_id long, text string"), wider, public_tokenizers.PATTERN).collect()
    assert np.frombuffer(rows[0]["ids"], "<u4").tolist() == packing.Encoder(wider, public_tokenizers.PATTERN).encode("x").tolist()


def test_packing_long_white_space(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(packing.ranks_file(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    n = packing.LONG_TEXT
    for text in ("a" + " " * n + "b c", "a " + "\n" * (n + 1), " \t\u3000\x85" * n + "!x" + "\n" * (n - 1) + "1" + " " * n + "<|endoftext|>" + " " * n + "é",
                 "x" + "\x1c" * n + "y"):
        assert encoder.encode(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
    text = "x y" + "\n" * 2_000_000 + "z"
    rows = packing.pack_documents(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).toPandas()
    ids = encoder.encode(text)
    assert encoder.coder.decode(ids[:-1].tolist()) == text
    assert rows[rows["doc_id"] == 1]["doc_tokens"].unique().tolist() == [len(ids)] and rows["length"].sum() == len(ids) + 2


def test_hilbert_steps_are_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3) * (1 << (packing.BITS - 3))
    path = grid[np.argsort(packing.hilbert(grid))] >> (packing.BITS - 3)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_packing_odd_rows(odd, none):
    rows = packing.pack_documents(odd).toPandas()
    assert (rows["length"] > 0).all() and rows.groupby("sequence_id")["length"].sum().max() <= 2048
    assert (rows["doc_tokens"] == 1).sum() == 2 and rows["length"].sum() == rows.drop_duplicates()["length"].sum()
    assert packing.pack_documents(none).count() == 0
