"""Quality rules, decontamination, encoding and token counts against brute force and the libraries."""

import hashlib
import random
import tracemalloc
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from itemflow.llm import sp_encode, textpack, token_counts
from itemflow.llm.decontaminate import ItemAutomaton, matched_spans, remove_spans
from itemflow.llm.line_quality import clean_documents, clean_lines
from itemflow.llm.queries import encoded_digest, tokenizer_path
from itemflow.llm.sp_encode import encode_documents
from itemflow.llm.token_counts import count_documents, longest_within

STRANGE = [*" abet▁.\n\t'éS!3", "ß", "　", "ﬁ", "𝔘", "\x00", "日本", "é", "<s>", "  ", "<0x0A>", "the ", "ing", "'ll", "'VE", "İ", "Σ", "²", "\x85"]


def texts_of(seed, n, size=40):
    draw = random.Random(seed)
    made = ["".join(draw.choice(STRANGE) for _ in range(draw.randint(0, size))) for _ in range(n)]
    return [None, "", " ", "▁", "a" * 3000, "x y" * 2000, "日本語" * 100, *made]


def test_windows_stay_in_their_text():
    piece = next(textpack.pieces(pa.array(["a b", "", "c d e", None, "f"])))
    words = piece.runs(textpack.NOT_SPACE)
    assert words.counts.tolist() == [2, 0, 3, 0, 1]
    assert textpack.windows(words.first, 2)[1].tolist() == [0, 2, 2]


def test_pieces_of_sliced_null_and_long_columns():
    column = pa.array(["zz", "ab", None, "c" * 50, ""]).slice(1)
    got = [bytes(p.buf[a:b]) for p in textpack.pieces(column, 8) for a, b in zip(p.starts, p.ends, strict=True)]
    assert got == [b"ab", b"", b"c" * 50, b""]


def test_lines_are_those_of_split():
    texts = ["a\nb", "", "\n", "x\n\n", "\ny"]
    piece = next(textpack.pieces(pa.array(texts)))
    lines = piece.lines()
    got = [[bytes(piece.buf[lines.start[k] : lines.end[k]]).decode() for k in range(a, b)] for a, b in zip(lines.first, lines.first[1:], strict=False)]
    assert got == [t.split("\n") for t in texts]


def test_line_rules(docs):
    good = " ".join(["This line ends well and has words."] + [f"Word{i} number{i}." for i in range(30)])
    bad = ["no end mark here", "home | about | contact.", "### %%% $$$ &&&.", "WOW!! NOW!! YES.", "All Rights Reserved."]
    texts = [None, "", "\n" * 5, good, good + "\n" + "\n".join(bad), "word\n" * 80, "x" * 100_000]
    rows = {r.doc_id: r for r in clean_lines(docs(*texts)).collect()}
    assert len(rows) == len(texts)
    assert (rows[0].n_words, rows[0].kept, rows[0].clean_text) == (0, False, None)
    assert rows[3].kept and rows[3].clean_text == good
    assert rows[4].lines_removed == 5 and rows[4].clean_text == good
    assert rows[5].base_failed and rows[5].n_dup_lines == 79 and rows[5].n_repeat_words == 80
    kept = clean_documents(docs(*texts))
    assert kept.columns == ["doc_id", "text", "n_words", "shard"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4]


def test_automaton_finds_every_window():
    draw = random.Random(2)
    items = [(str(i), [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 9))]) for i in range(12)]
    made = ItemAutomaton(items, 4)
    words = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    want = set()
    for name, own in items:
        n = min(4, len(own))
        for k in range(len(own) - n + 1):
            want |= {(i, i + n, name) for i in range(len(words) - n + 1) if words[i : i + n] == own[k : k + n]}
    assert {(a, b, x) for a, b, names in made.matches(words) for x in names} == want


@pytest.mark.parametrize("group_words", [100_000, 20])
def test_decontamination_in_one_or_many_groups(spark, docs, group_words):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = spark.createDataFrame([(7, item), (10, "short test item"), (3, None), (None, item), (4, "")], "item_id long, text string")
    texts = [None, "", f"x {item.upper()} y", "a short TEST item!", "nothing here", "z " * 1000 + item]
    rows = {r.doc_id: r for r in matched_spans(docs(*texts), items, group_words=group_words).collect()}
    assert [rows[i]["items"] for i in range(6)] == [[], [], ["7"], ["10"], [], ["7"]]
    assert [tuple(s) for s in rows[2].spans] == [(1, 13)] and rows[5].n_words == 1012
    clean = {r.doc_id: r.text for r in remove_spans(docs(*texts), items, group_words=group_words).collect()}
    assert clean == {0: None, 1: "", 4: "nothing here", 5: "z " * 1000 + " "}


def test_no_items_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.items for r in matched_spans(docs("a b"), none).collect()] == [[]]
    assert matched_spans(docs().limit(0), none).collect() == []


def test_encoding_is_the_library_s(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = texts_of(1, 600)
    rows = encode_documents(docs(*texts), tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "") + [2]
        assert r.ids == ids and r.decoded == library.decode(ids)


def test_memory_of_encoding_follows_the_piece_not_the_batch():
    model = sp_encode.PieceModel(open(tokenizer_path("piece_bpe_32k.model"), "rb").read())
    draw = random.Random(8)
    words = ["".join(draw.choices("etaoinshr", k=draw.randrange(1, 9))) for _ in range(3000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(1800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["_id", "_text"])
    assert batch.nbytes > 3 << 20
    tracemalloc.start()
    rows = sum(made.num_rows for made in sp_encode._encoded(model, batch, True))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and most < 64 << 20


def test_spans_cover_the_text_and_hold_their_pieces(docs):
    texts = ["Hello  wörld\n日本 ﬁ", "a b"]
    model = sp_encode.PieceModel(open(tokenizer_path("piece_bpe_32k.model"), "rb").read())
    for r in encode_documents(docs(*texts), tokenizer_path("piece_bpe_32k.model"), eos=False).collect():
        data, at = texts[r.doc_id].encode(), 0
        for i, a, b in zip(r.ids, r.starts, r.stops, strict=True):
            piece = model.pieces[i].replace("▁", " ")
            if model.kinds[i] == sp_encode.NORMAL:
                assert data[a:b].decode() == (piece if a or r.starts[0:2] == [0, a] and b - a == len(piece.encode()) else piece[1:])
            assert a <= at <= b
            at = b
        assert at == len(data)


def test_character_map_is_the_library_s():
    """The longest prefix through a compiled map, against the library's own normaliser."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    rules = dict(sp_encode._fields(next(v for f, v in sp_encode._fields(library.serialized_model_proto()) if f == 3)))
    made = sp_encode.CharMap(rules[2])
    for text in ["ﬁne ①②", "ｱﾞ ㍿", "é Å", "plain", "", "Ⅷ½"]:
        new, start, stop = made.normalised(text.encode())
        assert new.decode() == unicodedata.normalize("NFKC", text)
        assert len(start) == len(stop) == len(new) and (np.diff(start) >= 0).all()
        assert not len(new) or (start[0] == 0 and stop[-1] == len(text.encode()))


def test_digests(docs):
    (row,) = encoded_digest(encode_documents(docs(None), tokenizer_path("piece_bpe_32k.model"))).collect()
    assert (row.n_tokens, row.ids_sha256) == (1, hashlib.sha256(b"2").hexdigest())
    assert row.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_every_prefix_has_the_library_s_count(docs):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = [*texts_of(2, 300), "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "it's we'LL 'tis ''s"]
    rows = count_documents(docs(*texts), tokenizer_path("word_bpe_49k.json")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.n_tokens == count(text), text
        if len(text) < 100 and unicodedata.is_normalized("NFC", text) and not {"İ", "<"} & set(text):
            assert r.prefix_tokens == [count(text[: k + 1]) for k in range(len(text))]


def test_budgets_need_no_encoding(docs):
    text = "the quick brown fox jumps over the lazy dogs"
    row = count_documents(docs(text), tokenizer_path("word_bpe_49k.json")).select("*", longest_within(3).alias("k")).first()
    fits = [k + 1 for k, n in enumerate(row.prefix_tokens) if n <= 3]
    assert row.k == max(fits) and text[: row.k] == "the quick brown "


def test_no_rows(docs):
    assert encode_documents(docs().limit(0), tokenizer_path("piece_bpe_32k.model")).collect() == []
    assert count_documents(docs().limit(0), tokenizer_path("word_bpe_49k.json")).collect() == []
    assert clean_lines(docs().limit(0)).collect() == []
    assert token_counts.PATTERN.startswith("'s")
