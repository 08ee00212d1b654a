"""Merkle manifest, token files and aligned tokenisers: against plain Python versions and the libraries."""

import hashlib
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from itemflow.llm import queries, textpack, token_align, token_files
from itemflow.llm.merkle import build_manifest, folded, leaf_hash, proof_hash, proofs
from itemflow.llm.queries import tokenizer_path
from itemflow.llm.token_align import Block, Pair, align_documents
from itemflow.llm.token_files import Grammar, compress, read_token_files, write_token_files

ODD = [
    None, "", " ", "a", "a", "\n\n x  y\tz ", "don't STOP 123 4① ①", "é İx Σς ﬁ", "<|endoftext|> a<|endoftext|>b <s> </s>",
    "日本語のテキスト。", "▁x ▁▁", "\x00\x01 ‍😀👩‍👩‍👧", "ab" * 30_000, "word " * 20_000, "  　x", "aaaa " * 50,
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, fan=8):
    """All levels of a plain tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
    return levels


def manifest_brute(rows, fan=8):
    """(group, key, leaf) to (leaf, subroot, root, siblings level by level) in order."""
    groups = defaultdict(list)
    for group, key, leaf in rows:
        groups[group].append((key is not None, key, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, _, leaf in sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))], fan) for g in order}
    top = tree([trees[g][-1][0] for g in order], fan) if order else [[]]

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // fan * fan
            out += level[run : i] + level[i + 1 : run + fan]
            i //= fan
        return out

    return sorted(
        (leaf, trees[g][-1][0], top[-1][0], sha("".join(siblings(trees[g], i) + siblings(top, n))))
        for n, g in enumerate(order) for i, leaf in enumerate(trees[g][0])
    )


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("fan", [2, 8])
def test_manifest_against_a_plain_tree(spark, levels, fan):
    draw = random.Random(levels * fan)
    sizes = {"en": 130, "de": 64, "ä": 9, "b": 8, "": 2, None: 1, "z": 1}
    rows = [(g, None if k == 3 else k // 2, sha(f"{g}{draw.random()}")) for g, n in sizes.items() for k in range(n)]
    rows += [("en", 5, sha("again"))] * 20
    draw.shuffle(rows)
    given = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").withColumn("manifest", F.lit(1)).withColumn("_group", F.lit("x"))
    found = proofs(build_manifest(given.drop("manifest"), fan=fan, levels=levels), fan)
    found = found.select("leaf", "manifest.*", "_group").withColumn("folded", folded(F.col("leaf"), F.col("path")))
    got = found.select("leaf", "subroot", "root", proof_hash(F.col("path")), F.col("folded") == F.col("root"), "_group").collect()
    assert sorted(tuple(r)[:4] for r in got) == manifest_brute(rows, fan)
    assert all(r[4] and r[5] == "x" for r in got)


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], "lang string, doc_id long, leaf string")
    made = build_manifest(none)
    assert proofs(made).collect() == [] and made.root().collect() == []
    one = build_manifest(spark.createDataFrame([(None, None, sha("a"))], none.schema))
    row = proofs(one).collect()[0]
    assert row.manifest.root == row.manifest.subroot == row.leaf and row.manifest.path == []


def test_leaf_tells_null_from_empty_and_fields_apart(spark):
    rows = [(None, "", 1), ("", None, 1), ("-", "x", 1), ("1:x", "é", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string, c long").select(leaf_hash(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [sha("-0:1:1"), sha("0:-1:1"), sha("1:-1:x1:1"), sha("3:1:x2:é-")]


def test_tampered_documents_do_not_verify(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_merkle_manifest(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id].text
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None and any("A" <= c <= "Z" for c in text)
        assert r.verified == (not changed)


def test_any_ids_come_back_from_their_grammar():
    draw = random.Random(1)
    cases = [[], [7], [7, 7], [7] * 1000, [1, 2] * 500, [1, 1, 2] * 300 + [1] * 77, list(range(5000)) * 3]
    cases += [[int(draw.paretovariate(1)) % 900 for _ in range(6000)], [draw.randrange(1 << 32) for _ in range(500)] * 20]
    for case in cases:
        ids = np.array(case, np.uint32)
        made = Grammar.from_bytes(compress(ids, 4).to_bytes())
        assert made.ids().tolist() == case
        for _ in range(20):
            a = draw.randrange(len(case) + 1)
            b = draw.randrange(a, len(case) + 1)
            assert made.ids(a, b).tolist() == case[a:b]
        seen = Counter(zip(made.symbols[:-1].tolist(), made.symbols[1:].tolist()))
        assert not [p for p, n in seen.items() if n >= 4 and p[0] != p[1]], "no frequent pair is left"
        sizes = np.concatenate([np.ones(len(made.terminals)), made.lengths])
        assert (made.lengths == sizes[made.left] + sizes[made.right]).all()
    with pytest.raises(ValueError):
        Grammar.from_bytes(b"else")


@pytest.mark.parametrize("shard", [1, 50, 1 << 19])
def test_token_files_come_back_in_key_order(spark, tmp_path, shard):
    rows = [(None if i == 4 else 100 - i % 14, t, "x") for i, t in enumerate([*ODD, *ODD[:5]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    write_token_files(docs, tokenizer_path("word_bpe_49k.json"), f"{tmp_path}/files", shard_ids=shard)
    got = sorted(read_token_files(spark, f"{tmp_path}/files").collect(), key=lambda r: r.start)
    want = Counter((k, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2])) for k, t, _ in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [r.doc_id is None for r in got] == sorted((r.doc_id is None for r in got), reverse=True)
    keys = [r.doc_id for r in got if r.doc_id is not None]
    assert keys == sorted(keys)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def word_encoder():
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return token_files.WordEncoder(f.read())


def encoded(encoder, texts, most):
    out = []
    for piece in textpack.pieces(pa.array(texts, pa.string()), most):
        ids, first = encoder(piece)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return out


def test_known_words_take_no_object_each(monkeypatch):
    texts, encoder = [" ".join(f"{i:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(20_000))] * 2, word_encoder()
    spread, blocks = token_files.spread, []

    def counted(start, counts):
        blocks.append(sys.getallocatedblocks())
        return spread(start, counts)

    once = encoded(encoder, texts[:1], 1 << 20)
    monkeypatch.setattr(token_files, "spread", counted)
    before = sys.getallocatedblocks()
    piece = next(textpack.pieces(pa.array(texts[1:]), 1 << 20))
    ids = encoder(piece)[0]
    assert ids.tolist() == once[0] and max(blocks) - before < 5_000


@pytest.mark.parametrize("words, size", [(3, 1 << 20), (1 << 20, 40), (1 << 20, 1 << 20)])
@pytest.mark.parametrize("most", [1, 300, 1 << 20])
def test_words_are_the_library_s_when_few_are_remembered(monkeypatch, words, size, most):
    monkeypatch.setattr(token_files, "REMEMBERED", words)
    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", size)
    draw = random.Random(5)
    texts = [t or "" for t in ODD if len(t or "") < 1000]
    texts += ["".join(draw.choices("aBc1 '<é\n.①\x00\x01\x1c\x7f", k=draw.randrange(40))) for _ in range(400)]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    encoder = word_encoder()
    for _ in range(2):
        assert encoded(encoder, texts, most) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_of_two_bytes_are_the_library_s():
    library, encoder = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), word_encoder()
    texts = [t for i in range(0x80, 1 << 11) for t in (chr(i), f"a{chr(i)}B{chr(i)} {chr(i)}.", f"1{chr(i)}\u0301{chr(i)}'s {chr(i)}\u0308x")]
    draw = random.Random(2)
    texts += ["".join(chr(draw.choice([*range(0x20, 0x7F), *range(0xC0, 0x180), *range(0x300, 0x380), 0x3A3, 0x4E00])) for _ in range(12)) for _ in range(2000)]
    for most in (1, 2000):
        assert encoded(encoder, texts, most) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_of_letters_are_normalised_and_cut_before(monkeypatch):
    encoder = word_encoder()
    words = ["Été", "naïve", "ÜBER", "слово", "Λόγος"]
    texts = ["\n".join(w + sign for w in words for sign in ("", ".", ",", "!", ";", ")"))]
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    given, library = [], encoder.library

    class Watched:
        def encode_batch_fast(self, some, **more):
            given.extend(some)
            return library.encode_batch_fast(some, **more)

    monkeypatch.setattr(encoder, "library", Watched())
    assert encoded(encoder, texts, 1 << 20) == want
    assert len(encoder.known) == 10 and not any(c.isalpha() for t in given for c in t)


def test_words_that_are_no_characters_stay_whole():
    encoder = word_encoder()
    texts = [b"\xc3", b"\xc3a\xa9", b"a\xc3", b"\xa9b", b"\xc3\xa9 \xc3", b"\xc1\xa9"]
    column = pa.Array.from_buffers(pa.string(), len(texts), pa.array(texts, pa.binary()).buffers())
    ids, first = encoder(next(textpack.pieces(column, 1 << 20)))
    want = [encoder.library.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want


def test_words_of_one_hash_are_told_apart():
    known = token_files.Remembered(64)
    buf, hashes = np.frombuffer(b"abcdabxd", np.uint8), np.full(1, 77, np.uint64)
    at = lambda a, b: (hashes, buf, np.array([a]), np.array([b]))
    assert known.find(*at(0, 4)).tolist() == [-1]
    known.add(hashes, [b"abcd"], [b"\x01\0\0\0"])
    assert [known.find(*at(*x)).tolist() for x in ((0, 4), (4, 8), (0, 3))] == [[0], [-1], [-1]]
    many = np.full(20, 78, np.uint64)
    known.add(many, [b"ab"] * 20, [b""] * 20)
    assert known.find(many[:1], buf, np.array([0]), np.array([2])).tolist() != [-1] and len(known) == 21


def test_token_files_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(docs, tokenizer_path("word_bpe_49k.json"), f"{tmp_path}/files")
    assert read_token_files(spark, f"{tmp_path}/files").collect() == []


def test_token_files_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    library, at, want = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 0, set()
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.add((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r) for r in queries.op12_token_files(spark, sf_dir).collect()]
    assert len(got) == len(rows) and set(got) == want


def align_brute(texts):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    first = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def ends(parts):
        out, n = [], 0
        for p in parts:
            n += len(p)
            out.append(n)
        return out

    def piece(i):
        return bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    made = []
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False)
        b = second.encode(text or "")
        parts_a, parts_b = [bytes(letter[c] for c in t) for t in a.tokens], [piece(i) for i in b]
        body = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != body or b"".join(parts_b) != body:
            made.append((0, 0, [], Counter()))
            continue
        ends_a, ends_b, groups, low = ends(parts_a), ends(parts_b), [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            groups.append(([i for i, e in zip(a.ids, ends_a) if low < e <= cut], [i for i, e in zip(b, ends_b) if low < e <= cut]) if len(ends_a) < 500 else None)
            low = cut
        if groups and groups[0] is None:  # long texts: in one pass
            groups, i, j = [], 0, 0
            for cut in sorted(set(ends_a) & set(ends_b)):
                k, m = i, j
                while ends_a[k] < cut:
                    k += 1
                while ends_b[m] < cut:
                    m += 1
                groups.append((a.ids[i : k + 1], b[j : m + 1]))
                i, j = k + 1, m + 1
        made.append((len(a.ids), len(b), groups, Counter((x, y) for xs, ys in groups for x in xs for y in ys)))
    held = Counter(p for *_, links in made for p in links)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [
        (n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
         sum(n * held[p] for p, n in links.items()), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups))
        for n_a, n_b, groups, links in made
    ]


@pytest.mark.parametrize("block", [1, 8 << 20])
def test_alignment_of_odd_texts(spark, docs, block):
    texts = [*ODD, "x" * 3000 + "日本" * 40, "qzxjkv" * 70]
    made = align_documents(docs(*texts), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), keep_groups=True, block_bytes=block)
    got = {r.doc_id: r for r in made.documents().collect()}
    want = align_brute(texts)
    for i, w in enumerate(want):
        assert tuple(got[i])[1:7] == w[:6], texts[i]
        assert got[i].groups == w[6] and got[i].groups_sha256 == (sha(w[6]) if w[0] else "")
    assert made.pairs.where("best").groupBy("a").count().where("count < 1").isEmpty()


def align_pair():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f, open(tokenizer_path("piece_bpe_32k.model"), "rb") as g:
        return Pair(f.read(), g.read())


def test_a_word_is_tokenised_once_in_a_block(monkeypatch):
    pair, given = align_pair(), []
    texts = [" ".join(f"w{i % 50}." for i in range(k, k + 400)) + "\nend" for k in range(30)]
    encode = pair.encode
    monkeypatch.setattr(pair, "encode", lambda some: given.extend(some) or encode(some))
    block = Block(pair, True)
    for piece in textpack.pieces(pa.array(texts), 50_000):
        block.add(pa.array(range(len(piece))), piece)
    assert sum(map(len, given)) < 1000
    assert [*zip(*np.concatenate(block.docs, 1)[:4].tolist(), block.texts, strict=True)] == [(*w[:4], w[6]) for w in align_brute(texts)]


@pytest.mark.parametrize("by_word", [True, False])
def test_words_are_cut_where_no_token_reaches_over(by_word):
    draw = random.Random(3)
    white = [" ", " ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u180e", "\u200b", "\u2028", "\u3000", "\ufeff", "\x00", "\v"]
    others = ["a", "the", "The", ".", "'s", "12", "é", "日本", "<unk>", "▁", "{", ";", "”", "’", "</s>", "<0x0A>", "\u0308"]
    texts = ["".join(draw.choice(white if draw.random() < 0.5 else others) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    pair = align_pair()
    assert pair.by_word
    pair.by_word = by_word
    block = Block(pair, True)
    for piece in textpack.pieces(pa.array(texts), 5_000):
        block.add(pa.array(range(len(piece))), piece)
    got = [*zip(*np.concatenate(block.docs, 1)[:4].tolist(), block.texts, strict=True)]
    assert [t for t, g, w in zip(texts, got, align_brute(texts), strict=True) if g != (*w[:4], w[6])] == []


@pytest.mark.parametrize("most", [1, 7, 1 << 16])
def test_documents_that_hold_a_pair_are_counted_some_at_a_time(monkeypatch, most):
    monkeypatch.setattr(token_align, "HELD", most)
    draw = np.random.default_rng(1)
    counts, per_doc = draw.integers(0, 5, 30), draw.integers(0, 6, 200)
    of, words = draw.integers(0, 40, counts.sum()), draw.integers(0, 30, per_doc.sum())
    first, at = np.cumsum(counts) - counts, np.cumsum(per_doc) - per_doc
    want = Counter(p for i, n in zip(at, per_doc) for p in {int(x) for w in words[i : i + n] for x in of[first[w] : first[w] + counts[w]]})
    assert token_align._holders(words, per_doc, counts, of, 40).tolist() == [want[p] for p in range(40)]


def test_a_block_is_kept_in_small_rows(spark):
    """A row held a whole block, and buffers of that size added up in executors."""
    draw = random.Random(17)
    texts = [" ".join(f"{draw.choice('abcde')}{draw.randrange(400)}" for _ in range(1000)) for _ in range(240)]
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id INT, text STRING").coalesce(1)
    whole, cut = (align_documents(rows, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), block_bytes=n) for n in (4 << 20, 1 << 14))
    size = " + ".join([*(f"length({c})" for c in ("windows", "window_pairs", "pair_of", "pair_times")), "16 * size(pairs)", "100 * size(keys)"])
    blocks, most, total = whole.blocks.selectExpr("count(DISTINCT block)", f"max({size})", f"sum({size})").first()
    assert blocks == 1 and total > 500_000 and most < 100_000
    assert cut.blocks.select("block").distinct().count() > 1
    assert {tuple(r) for r in whole.documents().collect()} == {tuple(r) for r in cut.documents().collect()}


def test_rows_of_a_block_come_in_any_order(monkeypatch):
    monkeypatch.setattr(token_align, "PART", 500)
    block, texts = Block(align_pair(), True), [f"one w{i} and x{i % 7}" for i in range(300)]
    for piece in textpack.pieces(pa.array(texts), 1000):
        block.add(pa.array(range(piece.row, piece.row + len(piece))), piece)
    rows = [*block.rows(3)]
    assert len(rows) > 20 and all(r.num_rows == 1 for r in rows)
    random.Random(2).shuffle(rows)
    made = token_align._whole(pa.Table.from_batches(rows))
    assert made["keys"].to_pylist() == [*range(300)] and made["groups"].to_pylist() == block.texts
    assert made["windows"].tolist() == np.concatenate(block.windows).tolist()
    pairs = made["pairs"].to_pylist()
    assert pairs == sorted(set(pairs))
    assert all(pairs[r.column("first")[0].as_py() :][: len(own)] == own for r in rows for own in r.column("pairs").to_pylist())


def test_documents_without_much_text_close_a_block(spark):
    rows = spark.range(50_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'a', null) AS text").coalesce(1)
    made = align_documents(rows, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), block_bytes=1 << 20)
    assert made.blocks.select("block").distinct().count() > 1
    assert {tuple(r) for r in made.documents().groupBy("n_a", "count_sum").count().collect()} == {(0, 0, 25_000), (1, 25_000, 25_000)}


def test_texts_that_are_no_characters_have_no_tokens(spark):
    rows = spark.sql("SELECT id AS doc_id, CASE id WHEN 0 THEN cast(x'61ff2062' AS string) ELSE 'a b' END AS text FROM range(2)")
    made = align_documents(rows, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert {r.doc_id: r.n_a for r in made.documents().collect()} == {0: 0, 1: 2}


def test_alignment_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (*w[:6], sha(w[6]) if w[0] else "") for r, w in zip(rows, align_brute([r.text for r in rows]), strict=True)}
    got = {r[0]: tuple(r)[1:] for r in queries.op13_token_align(spark, sf_dir).collect()}
    assert got == want


def test_alignment_of_an_empty_table(spark, docs):
    made = align_documents(docs().limit(0), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert made.documents().collect() == [] and made.pairs.collect() == []
