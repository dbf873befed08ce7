"""Packing: ids against the tokenizer, the law of the layout, the curve, odd rows."""

import collections
import itertools
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratamart.llm import packing

SMALL = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, rid long, ids string, key long, at long"
ODD = [
    (1, "One two\tthree  four's 12", "en", 1, "x", 1, 1),
    (1, "One two\tthree  four's 12", "en", 1, "x", 1, 1),
    (2, None, "en", None, None, None, None),
    (3, "", None, 0, "", 0, 0),
    (4, " \n ", None, 0, "", 0, 0),
    (None, "a b\x1c!\x1c!́ <|endoftext|> ΣΑΣ İ é", "el", 5, "y", 5, 5),
    (9_007_199_254_740_993, "unusual" * 9000 + " " + "word other " * 9000, "en", 5, "y", 5, 5),
]


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END] for t in texts]


def check_layout(pieces, rows):
    """Every id in one piece, sequences gapless and full, checksums right."""
    wanted = collections.Counter()
    for (doc_id, *_), ids in zip(rows, expected_ids([r[1] for r in rows])):
        wanted[doc_id, tuple(ids)] += 1
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for held in by_sequence.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(held))
    sizes = [sum(n for _, n in by_sequence[s]) for s in sorted(by_sequence)]
    assert sorted(by_sequence) == list(range(len(sizes)))
    assert all(n == packing.LENGTH for n in sizes[:-1]) and (not sizes or sizes[-1] <= packing.LENGTH)
    # Along the line, pieces of one row follow one another: whole rows are found again.
    line = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    found, open_ids = collections.Counter(), []
    for p in line:
        assert p.start == len(open_ids)
        open_ids += np.frombuffer(p.ids, "<u4").tolist()
        if len(open_ids) == p.doc_tokens:
            found[p.doc_id, tuple(open_ids)] += 1
            open_ids = []
    assert not open_ids and found == wanted


@pytest.mark.parametrize("rows", [[], ODD[2:3], ODD])
def test_odd_rows(spark, rows):
    check_layout(packing.pack(spark.createDataFrame(rows, SHAPE)).collect(), rows)


HARD = [
    *["it's", "IT'S", "''s", "don't!", "'tis", "rock'n'roll", "x<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|>.", "end</w>"],
    *["foo),", "a.b.c...", "12,5", "3rd", "№5", "ÀÉÎ", "École.", "Éé\u0301", "e\u0301cole", "\u0301x", "İI", "ŉx", "ſet"],
    *["Ÿes", "ß", "ẞ", "ΣΑΣ", "naïve-té", "日本語。", "a\u00a0b", "a\u2028b", "\x1c!\x1c", "a\x0bb", "\u200dx", "ﬁn", "Ǆ", "😀!", "--", "a_b_"],
]


def test_words_as_the_tokenizer_has_them():
    with open(packing.vocabulary_path(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    assert encoder.by_words
    texts = [*HARD, " ".join(HARD), "\n".join(HARD), "\t\r\n".join(w + "..." for w in HARD), "".join(HARD)]
    letters = [chr(c) for c in range(0xC0, 0x180)]
    texts += [" ".join(c + "a" + c for c in letters), " ".join(c + "!" for c in letters)]
    for text, ids in zip(texts, expected_ids(texts)):
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == ids, text


def test_another_vocabulary_takes_whole_texts():
    from tokenizers import Tokenizer

    with open(packing.vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    encoder, plain = packing.Encoder(vocabulary), Tokenizer.from_str(vocabulary)
    assert not encoder.by_words
    for text in HARD:
        got = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
        assert got == [*plain.encode(text, add_special_tokens=False).ids, packing.END]


def test_whole_table_with_a_hot_text(spark, monkeypatch):
    """Copies of one text are spread over ranges by their row number."""
    monkeypatch.setattr(packing, "RANGE_ROWS", 50)
    monkeypatch.setattr(packing, "WORDS_KEPT", 300)
    monkeypatch.setattr(packing, "IDS_AT_ONCE", 2000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(7, "the same words again and again")] * 120
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check_layout(packing.pack(df).collect(), rows)
    slim = df.selectExpr("monotonically_increasing_id() as rid", "1L as key", "2L as n")
    at = sorted(r["at"] for r in packing.laid_out(slim).collect())
    assert at == list(range(0, 2 * len(rows), 2))


def test_query_agrees_with_pack(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = packing.op11_packing(spark, SMALL)
    assert a.columns == [c.split()[0] for c in packing.PIECE.split(", ")]
    assert sorted(a.collect()) == sorted(packing.pack(docs).drop("ids").collect())


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_steps_to_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = packing.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_neighbours_are_alike(spark):
    """Documents next to each other share their language far more often than by chance."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = packing.pack(docs, with_ids=False).filter("start = 0").join(docs, "doc_id")
    langs = [r.lang for r in first.orderBy("sequence_id", "offset").collect()]
    chance = sum((n / len(langs)) ** 2 for n in collections.Counter(langs).values())
    alike = np.mean([a == b for a, b in itertools.pairwise(langs)])
    assert alike > 1.5 * chance
