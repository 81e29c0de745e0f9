import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from oracle.compare import connect
from reelgauge.llm import token_files
from reelgauge.llm.tokens import Encoder, encoder, vocabulary_path
from reelgauge.session import fresh_path

TEXTS = [
    "", "  ", "a  b", " a", "a ", "a\n\nb", " \n x", "it's 's  \t x\r\ny", "<|endoftext|> a <|endoftext|>", "é ́x",
    "a b　c d", "\x1c a b\x1f c", "İ x ϐ", "x́ y\ńz", "word, word. word", "don't. can't,", "a.b x!", "中文 字, 字.", "𝒳 y",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_whole_texts(name):
    code = encoder(name)

    def check(text):
        assert code.encode([text])[0].tolist() == code.tokenizer.encode(text, add_special_tokens=False).ids

    for text in TEXTS:
        check(text)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.sampled_from(["the", "Cat", " ", "\n", "'s", ".", ",", "é", "ß", "İ", "9", "\t", "中", "_", "<|", "\x1d"]), max_size=12))
    def generated(parts):
        check("".join(parts))

    generated()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("form", ["a {}.", " {},", "{}! x", ".{} b"])
def test_ids_around_a_sign_for_every_code_point(name, form):
    code = Encoder(name)
    texts = [form.format(chr(c)) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    plain = [x.ids for x in Tokenizer.from_file(vocabulary_path(name)).encode_batch_fast(texts, add_special_tokens=False)]
    for start in range(0, len(texts), 20_000):
        ids, lengths = code.encode(texts[start : start + 20_000])
        found = np.split(ids, np.cumsum(lengths)[:-1])
        assert all(a.tolist() == b for a, b in zip(found, plain[start : start + 20_000], strict=True))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_all_documents_are_those_of_an_unchanged_tokenizer(name, sf_dir):
    texts = [x[0] or "" for x in connect(sf_dir.replace("sf0.001", "sf0.01")).execute("SELECT text FROM documents").fetchall()]
    ids, lengths = Encoder(name).encode(texts)
    plain = [x.ids for x in Tokenizer.from_file(vocabulary_path(name)).encode_batch_fast(texts, add_special_tokens=False)]
    assert lengths.tolist() == list(map(len, plain))
    assert ids.tolist() == [i for x in plain for i in x]


def test_a_full_memory_changes_nothing():
    small, large = Encoder("byte_bpe_50k.json", remembered=5), encoder("byte_bpe_50k.json")
    for texts in (["one two three four"], ["five six, seven. eight nine ten"], ["one six"], ["eleven twelve"]):
        assert small.encode(texts)[0].tolist() == large.encode(texts)[0].tolist()


def test_code_lengths_are_optimal_within_the_limit():
    counts = np.array([0, 5, 9, 12, 13, 16, 45])
    lengths = token_files.code_lengths(counts, 18)
    assert (lengths * counts).sum() == 224 and lengths[0] == 0
    skewed = np.array([1 << i for i in range(30)])
    lengths = token_files.code_lengths(skewed, 6)
    assert lengths.max() == 6 and sum(2.0 ** -int(x) for x in lengths) <= 1
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9), 3)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=900), st.integers(9, 14))
def test_blocks_round_trip(ids, longest):
    ids = np.array(ids, np.int64)
    codec = token_files.Codec(token_files.code_lengths(np.bincount(ids, minlength=301), longest))
    assert codec.decode(codec.encode(ids)).tolist() == ids.tolist()


def test_an_id_without_a_code_is_refused():
    with pytest.raises(ValueError):
        token_files.Codec(np.array([1, 1, 0])).encode(np.array([2]))


def test_files_round_trip(spark, odd, none, monkeypatch):
    folder = fresh_path(spark, "t")
    token_files.write_ids(token_files.tokenize(odd, "byte_bpe_50k.json", 0), folder)
    rows = token_files.digest(token_files.read_ids(spark, folder)).collect()
    code, start = encoder("byte_bpe_50k.json"), 0
    given_rows = sorted(odd.select("doc_id", "text").collect(), key=lambda x: (x[0] is not None, x[0] or 0))
    for got, (doc, text) in zip(sorted(rows, key=lambda x: x.start), given_rows, strict=True):
        ids = code.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        raw = np.array(ids, "<u4").tobytes()
        assert tuple(got) == (doc, start, len(ids), zlib.crc32(raw))
        start += len(ids)
    folder = fresh_path(spark, "t")
    token_files.write_ids(token_files.tokenize(none, "byte_bpe_50k.json", 0), folder)
    assert token_files.read_ids(spark, folder).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_are_those_of_the_plain_library(name):
    from tokenizers import Tokenizer

    from reelgauge.llm.tokens import vocabulary_path

    plain, code = Tokenizer.from_file(vocabulary_path(name)), Encoder(name)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "A  <|ENDOFTEXT|> b", "x<|endoftext|>y <|startoftext|>", " a b ", "a <| endoftext |> b"]
    for _ in range(2):  # learned, then remembered
        flat, lengths = code.encode([*texts, *TEXTS])
        want = [plain.encode(x, add_special_tokens=False).ids for x in [*texts, *TEXTS]]
        assert flat.tolist() == [y for x in want for y in x] and lengths.tolist() == [len(x) for x in want]
    assert plain.token_to_id("<|endoftext|>") in code.encode(texts[:1])[0]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_letter_beside_letters_signs_and_seams(name):
    """Pieces that are learned in one run of the library have the ids of whole texts."""
    code = encoder(name)
    some = [chr(x) for x in [*range(0x500), *range(0x1E00, 0x2100), 0x3000, 0x4E2D, 0xFB01, 0x1F600]]
    texts = [f"x {c}a b{c}. {c}{c} q{c}z, {c}" for c in some] + [f"A{c}\nB {c}9{c} c" for c in some]
    flat, lengths = code.encode(texts)
    plain = Tokenizer.from_file(vocabulary_path(name))
    for text, ids in zip(texts, np.split(flat, np.cumsum(lengths)[:-1]), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_all_documents_have_the_ids_of_the_library(spark, sf_dir, name):
    texts = [x.text for x in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    flat, lengths = encoder(name).encode(texts)
    plain = Tokenizer.from_file(vocabulary_path(name))
    for text, ids in zip(texts, np.split(flat, np.cumsum(lengths)[:-1]), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_large_vocabulary_is_asked_for_once(name, monkeypatch):
    """More words than a worker remembered before; the second time the library is not needed."""
    code = Encoder(name)
    words = [f" {a}{b}{c}{d}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst" for c in "aeioubcdgt" for d in "aeioubcdgtklmnpqrsvwxyzäöüßéèêñçøåæ"]
    texts = ["".join(words[x : x + 1000]) for x in range(0, len(words), 1000)] + [f" x{n}" for n in range(30_000)]
    first = [code.encode(texts[x : x + 50]) for x in range(0, len(texts), 50)]
    monkeypatch.setattr(code, "_learn", None)
    again = [code.encode(texts[x : x + 50]) for x in range(0, len(texts), 50)]
    assert all(np.array_equal(a, b) for x, y in zip(first, again, strict=True) for a, b in zip(x, y, strict=True))
    plain = Tokenizer.from_file(vocabulary_path(name)).encode(texts[7], add_special_tokens=False).ids
    assert code.encode(texts[7:8])[0].tolist() == plain


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_white_space_of_every_kind_and_long_pieces(name):
    """Columns of an Arrow batch, null and cut ones too; a full memory and a fresh one."""
    plain = Tokenizer.from_file(vocabulary_path(name))
    blanks = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", " ", "’", "​", " ", " ", " ", "　", "\0"]
    texts = [f"a{x} b{y}c\n{x}d. {y}e," for x in blanks for y in blanks]
    texts += [None, "", "x" * 15, " " + "x" * 14 + ".", " " + "x" * 15 + ".", "é" * 7 + " " + "é" * 8, "a\0 a", " a\0\0", "\0"]
    column = pa.array(["off", *texts]).slice(1)
    want = [plain.encode(x or "", add_special_tokens=False).ids for x in texts]
    for remembered in (3, 1000):
        code = Encoder(name, remembered=remembered)
        for _ in range(2):
            flat, lengths = code.encode(column)
            assert [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])] == want
