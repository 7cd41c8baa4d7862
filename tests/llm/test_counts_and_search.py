"""Collocations, token counts and lexical search: by brute force, on parts and limits."""

import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmart.llm import collocations, lexical_search, token_counts
from tests.llm.test_llm_queries import bag, by_sql, run, texts

DOCS = "doc_id long, text string, lang string"


# --- collocations ---------------------------------------------------------------


def collocations_by_force(rows, size, threshold, share, top):
    f, n = Counter(), Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(upper)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, size + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    f = {key: v for key, v in f.items() if v >= threshold}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or any(
            y == lang and len(q) > len(p) and 100 * b >= share * a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (y, q), b in f.items()
        ):
            continue
        cuts = [
            (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))
        ]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out.sort()
    ranks, result = Counter(), []
    for lang, score, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result


def phrase_rows(seed=3, n=300):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "of", "the", "a", "été", "x-y", "\x00", "\x1c", "q"] * 3
    vocabulary += [f"w{i}" for i in range(40)]
    rows = [(None, None, None), (1, "", "en"), (1, " .,;\n\t ", None), (2, "one", "fr")]
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        if i % 3 == 0:
            words += ["the", "city", "of", "new", "york"] * 2
        gaps = rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], k=len(words))
        text = "".join(w + g for w, g in zip(words, gaps, strict=True))
        rows.append((i % 7, text, rng.choice(["en", "en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("part_mass", [5_000_000, 2_000])
@pytest.mark.parametrize("share", [100, 60])
def test_collocations_by_force(spark, monkeypatch, part_mass, share):
    monkeypatch.setattr(collocations, "PART_MASS", part_mass)
    monkeypatch.setattr(collocations, "HELD", 500)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(collocations, "REMEMBERED", 50)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = collocations.collocations(docs, threshold=8, share=share, top=40)
    assert bag(found.collect()) == bag(collocations_by_force(rows, 5, 8, share, 40))


def test_nothing_but_pairs_of_a_small_filter(spark, monkeypatch):
    """With a filter that lets nearly all pass, the second count still decides."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 7)
    rows = phrase_rows(5, 100)
    found = collocations.collocations(spark.createDataFrame(rows, DOCS), size=3, threshold=5)
    assert bag(found.collect()) == bag(collocations_by_force(rows, 3, 5, 100, 2000))


def test_summary_keeps_every_frequent_hash():
    rng = np.random.default_rng(2)
    stream = np.concatenate([rng.integers(0, 1 << 40, 60_000), np.repeat(np.arange(300), 100)])
    rng.shuffle(stream)
    stream = stream.astype(np.uint64)
    summary = collocations.MisraGries(len(stream) // 100 + 1)
    for part in np.array_split(stream, 97):
        summary.add(*np.unique(part, return_counts=True))
    found = summary.frequent(100)
    assert set(range(300)) <= set(found.tolist())
    assert len(summary.hashes) <= summary.capacity and summary.error < 100


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        left, right = rng.randrange(10**13, 10**15), rng.randrange(10**13, 10**15)
        a = rng.randrange(100, min(left, right))
        n = rng.randrange(max(left, right), 10**17)
        while 1000 * a >= 10**18 or 1000 * a * n // (left * right) >= 2**63:
            a //= 10
        rows.append((a, n, left, right))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    columns = [F.col(c) for c in "anlr"]
    found = df.select("*", collocations.floor_score(*columns)).collect()
    assert all(r[4] == 1000 * r[0] * r[1] // (r[2] * r[3]) for r in found)


# --- token counts ---------------------------------------------------------------


def tokenizer_text(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


ODD_TEXTS = [
    None, "", " ", "\n\n  \t x", "It's we'll I'd THEY'RE", "<|endoftext|>", "a<|endoftext|>b",
    "<|endoftext|><|endoftext|> <|endoftext", "naïve \U0001f600‍\U0001f468 é", "1234567 89",
    "a \x1c b\x1c c\t d \u2028 e\u180e f", " lead", "x.\x1c.\n y \x85 z", "\n \n", "a\u3000 b \u3000c",
    "日本語のテキスト、です。", "x" * 5_000, "-" * 300, "a  b   c \r\n\r\n d\x00\x1c\x85　e", "ſ K Å ﬁ",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("common", [token_counts.COMMON, 3])
def test_token_counts_by_encoding(spark, any_table, name, common):
    content = tokenizer_text(name)
    tokenizer = Tokenizer.from_str(content)
    rows = any_table + [(i, t) for i, t in enumerate(ODD_TEXTS * 2)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, piece string")
    found = token_counts.token_counts(docs, content, common).collect()
    expected = [
        (d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids))
        for d, t in rows
    ]
    assert bag(found) == bag(expected)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_have_the_pre_tokens_of_the_text(name):
    content = tokenizer_text(name)
    whole = token_counts.PreTokens(content)
    cut = token_counts.PreTokens(token_counts.without_model(content))
    rng = random.Random(6)
    letters = list("ab1.' \n\t\r\x1c\x85\u00a0\u1680\u2007\u2028\u205f\u200b\u3000é\U0001f600ſŁ_*日")
    letters += ["s' t", " été", "<|endoftext|>", "\n\n", "Ünï..."]
    texts = ["".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(8_000)]
    texts = [text or None for text in texts]
    # A part of a batch, as its offsets do not start at 0.
    raw = pa.array([text and text.encode() for text in texts], pa.binary())[1_000:]
    text_no, code, distinct, specials = cut.chunks(raw)
    found = [Counter() for _ in range(len(raw))]
    specials = specials.tolist()
    for t, c in zip(text_no.tolist(), code.tolist(), strict=True):
        pieces, n = cut.pieces_of(distinct[c].as_py().decode())
        found[t].update(pieces)
        specials[t] += n
    for t, text in enumerate(texts[1_000:]):
        pieces, n = whole.whole(text or "")
        assert (found[t], specials[t]) == (Counter(pieces), n), repr(text)


@pytest.fixture(params=["small", "odd"])
def any_table(request, spark, sf_dir, odd_dir):
    if request.param == "odd":
        return texts(odd_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_special_tokens_that_need_their_surroundings_are_refused():
    content = json.loads(tokenizer_text("byte_bpe_50k.json"))
    content["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError):
        token_counts.PreTokens(json.dumps(content))


def test_bytes_that_are_no_text(spark):
    docs = spark.range(1).selectExpr("id as doc_id", "cast(X'61FF62' as string) as text")
    found = token_counts.token_counts(docs, tokenizer_text("byte_bpe_50k.json")).first()
    tokenizer = Tokenizer.from_str(tokenizer_text("byte_bpe_50k.json"))
    assert tuple(found) == (0, 3, len(tokenizer.encode("a�b").ids))


# --- lexical search -------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ITEMS": 3, "TILE_ITEMS": 2, "TILE_DOCS": 7, "TILE_TERMS": 3}])
def test_search_in_small_tiles_equals_sql(spark, odd_dir, monkeypatch, limits):
    from starmart.llm.queries import ORACLE_SQL

    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    columns, rows = run(spark, "op13_lexical_search", odd_dir)
    assert bag(rows) == bag(by_sql(odd_dir, ORACLE_SQL["op13_lexical_search"], columns))


def test_ties_at_the_last_rank_go_by_id(spark):
    docs = [(d, "same words here") for d in range(50, 0, -1)] + [(None, "same words here"), (99, "other")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    items = spark.createDataFrame([(7, "words")], "item_id long, text string")
    found = lexical_search.search(docs, items, top=10).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == list(range(1, 11))
    assert len({r["score"] for r in found}) == 1


def test_sums_beyond_exact_floats():
    """A term asked for very often is dealt out to cuts that stay exact."""
    rng = random.Random(4)
    entries = sorted((t, i, rng.randrange(1, 4 * 10**10)) for t in range(9) for i in range(3))
    cuts = lexical_search.exact_cuts(entries)
    for cut in cuts:
        for item in range(3):
            own = cut.weights[cut.items == item]
            assert sum(map(int, own)) * lexical_search.IMPACT < lexical_search.EXACT
    tile = lexical_search.Tile(np.arange(3), np.arange(9), cuts)
    impact = np.array([rng.randrange(lexical_search.IMPACT) for _ in range(9 * 4)])
    term, owner = np.tile(np.arange(9), 4), np.repeat(np.arange(4), 9)
    scores = lexical_search.tile_scores(tile, term, owner, impact, 4)
    for item in range(3):
        for doc in range(4):
            exact = sum(w * int(impact[9 * doc + t]) for t, i, w in entries if i == item)
            assert int(scores[item, doc]) == exact
