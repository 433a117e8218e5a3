"""Spelling variants, sentence pieces and token alignment against brute force and the tokenizers' own libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from emberline.llm import queries, sentence_pieces, spelling, token_links
from emberline.llm.piece_bpe import encoder

rng = random.Random(29)
MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "abcdefgh   \n\téü漢の😀.,!?'\"()[]{}0123456789tion ing the er"
TEXTS = [
    None, "", " ", "  ", "   a", "a  b   c", "a" * 900, "\n\n a\n  b\n", "漢字 ▁▁x", "😀 hi😀😀  😀", "<s> </s> <unk> <0x0A>", "\x00a\x00", " " * 40, "x" + " " * 47 + "y",
    "é" * 300, "\t\ta", "﻿a b", "▁", "<|endoftext|> hi", "one text twice", "one text twice", "spelling spelling speling spellings", "SPELLING spellins spellxing",
    *["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 300))) for _ in range(60)],
    " ".join(rng.choice(["spelling", "variant", "grouping", "groupings", "gruoping", "Variants"]) for _ in range(4000)),
]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "x", i, i, "p", "k") for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1, 1, "p", "k"), (3, "an id twice", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n long, row long, pairs string, key string").repartition(3)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_pieces_are_the_librarys(library):
    model = encoder(MODEL).model
    names = [p for p in model.normal]
    texts = [t for t in TEXTS if t] + ["".join(rng.choice(names) for _ in range(rng.randrange(1, 30))).replace("▁", " ") for _ in range(1500)]
    for text, want in zip(texts, library.encode(texts), strict=True):
        assert model.encode(text) == want
        assert model.decode(want) == library.decode(want)
    data = [(" " + t.replace("▁", " ")).encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    ids, at = encoder(MODEL)(np.frombuffer(b"".join(data), np.uint8), bounds)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == library.encode(texts)


def test_any_ids_decode_as_in_the_library(library):
    model = encoder(MODEL).model
    for _ in range(1500):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == library.decode(ids)


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "PART_BYTES", 500)
    for text in (TEXTS[-1], "a" * 5000, "a  b" * 900, " " * 3000):
        data = np.frombuffer((" " + text).encode(), np.uint8)
        assert sentence_pieces.ids_of(encoder(MODEL), data, np.array([0, len(data)]))[0].tolist() == library.encode(text)


def test_pieces_of_documents(spark, documents, library):
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    ids = [(i, library.encode(t)) for i, t in rows]
    same(sentence_pieces.digest(documents), [(i, len(x), sha(",".join(map(str, x))), sha(library.decode(x))) for i, x in ids])
    coded = sentence_pieces.encoded(documents)
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=repr) == sorted(ids, key=repr)
    same(sentence_pieces.decoded(coded), [(i, library.decode(x)) for i, x in ids])
    assert sentence_pieces.digest(documents.where("false")).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, 5]), (3, [])], "doc_id long, ids array<int>")
    same(sentence_pieces.decoded(odd), [(1, ""), (2, library.decode([5])), (3, "")])


def brute_alignment(rows):
    pieces, tokens = sentencepiece.SentencePieceProcessor(model_file=MODEL), Tokenizer.from_file(BYTES)
    tokens.encode_special_tokens = True
    of = token_links._byte_of_character()
    out, count = [], Counter()
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        a = tokens.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text or "")
        in_a = [bytes(of[c] for c in tokens.id_to_token(k)) for k in a]
        in_b = [bytes([int(pieces.id_to_piece(k)[3:-1], 16)]) if pieces.is_byte(k) else pieces.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or b"".join(in_a) != whole or b"".join(in_b) != whole:
            a, b, in_a, in_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in in_a]).tolist(), np.cumsum([len(x) for x in in_b]).tolist()
        links = [(a[j], b[k]) for j, x in enumerate(ends_a) for k, y in enumerate(ends_b) if x == y] if len(a) < 2000 else [(a[ends_a.index(x)], b[ends_b.index(x)]) for x in sorted({*ends_a} & {*ends_b})]
        cuts = [0, *sorted({*ends_a} & {*ends_b})]
        groups = [
            ",".join(str(t) for t, e in zip(a, ends_a, strict=True) if lo < e <= hi) + "|" + ",".join(str(t) for t, e in zip(b, ends_b, strict=True) if lo < e <= hi)
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        count.update(links)
        out.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, n, m, g, len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), sha(t) if n else "") for i, n, m, g, x, t in out], count


def test_alignment(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.where("length(text) < 20000 OR text IS NULL").collect()]
    small = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want, count = brute_alignment(rows)
    same(token_links.alignment(small), want)
    got = token_links.pair_counts(token_links.aligned(small))
    assert {(r.a_id, r.b_id): r.n for r in got.collect()} == dict(count)
    assert len(count) <= token_links.linkable_pairs(BYTES, MODEL) < 500_000
    kept = token_links.aligned(small, keep_groups=True).select("groups", "groups_sha256").collect()
    assert all((sha(r.groups) if r.groups else "") == r.groups_sha256 for r in kept)
    assert token_links.alignment(documents).count() == len(TEXTS) + 2
    assert token_links.alignment(documents.where("false")).count() == 0


def test_both_byte_level_libraries_agree():
    slow = Tokenizer.from_file(BYTES)
    slow.encode_special_tokens = True
    points = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b{c}1 {c}{c}x.{c}! {c} 2{c}" for c in map(chr, points)] + [" " + t for t in TEXTS if t] + [" " * 30000 + "a"]
    for text, want in zip(texts, slow.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert token_links.byte_encoder(BYTES)(text).tolist() == want.ids


def brute_variants(count, factor=10):
    near, wild = defaultdict(set), defaultdict(list)
    for w in count:
        for k in range(len(w)):
            wild[w[:k] + "\0" + w[k + 1 :]].append(w)
            if (v := w[:k] + w[k + 1 :]) in count:
                near[w].add(v)
                near[v].add(w)
    for group in wild.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    form = {}
    for w in count:
        if near[w]:
            v = min(near[w], key=lambda x: (-count[x], x))
            if count[v] >= factor * count[w]:
                form[w] = v
    out = []
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, count[w], len(near[w]), count.get(form.get(w))))
    return out


@pytest.mark.parametrize(("alphabet", "least", "group_rows"), [("ab", 3, 20_000), ("abc", 4, 7), ("abé漢", 2, 40), ("abcdefgh", 7, 3)])
def test_variants(spark, alphabet, least, group_rows):
    count = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(least, least + 6))): rng.choice([2, 3, 25, 30, 400, 4000, 40000]) for _ in range(500)}
    count |= {"a" * 500: 5, "a" * 501: 900, "a" * 250 + "b" + "a" * 249: 7}
    rows = [(w, n, 0, "x") for w, n in count.items()] + [(None, 9, 0, "x"), ("z" * 20, 1, 0, "x"), ("a", 10**6, 0, "x")]
    df = spark.createDataFrame(rows, "word string, n long, n_near long, form string").repartition(3)
    same(spelling.variant_groups(df, least, 2, 10, group_rows), brute_variants(count))
    assert spelling.variant_groups(df.where("false"), least).count() == 0


def test_tree_reports_ranges():
    for n in (1, 2, 3, 64, 65, 200):
        values = np.array(rng.sample(range(n), n))
        tree = spelling.WaveletTree(values)
        box = np.array([sorted(rng.choices(range(n + 1), k=2)) + sorted(rng.choices(range(n + 1), k=2)) for _ in range(60)])
        query, value = tree.report(*box.T)
        want = sorted((q, v) for q, (i, j, x, y) in enumerate(box.tolist()) for v in values[i:j].tolist() if x <= v < y)
        assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == want


def test_word_counts(spark, documents):
    want = Counter()
    for r in documents.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    same(spelling.word_counts(documents, deletion=3), list(want.items()))
    counts = {w: n for w, n in want.items() if n >= 2}
    same(spelling.variant_groups(spelling.word_counts(documents, deletion=3)), brute_variants(counts))


def test_registered_queries_return_the_contracts_columns(spark):
    folder = "/root/testdata/sf0.001"
    assert queries.op11_wavelet_spelling_variants(spark, folder).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert queries.op12_backtracking_pieces(spark, folder).dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert queries.op13_cross_tokenizer_links(spark, folder).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
