"""The registered queries: against their SQL, against brute force, and on odd tables."""

import hashlib
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from starmart.llm import (
    components,
    decontamination,
    line_dedup,
    mixing,
    near_dedup,
    substring_dedup,
)
from starmart.llm.common import written
from starmart.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents pages benchmark labels".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def words(text):
    return WORD.findall(text or "")


def run(spark, name, path):
    df = QUERIES[name](spark, path)
    return df.columns, [tuple(r) for r in df.collect()]


def bag(rows):
    return sorted(tuple((v is not None, str(v)) for v in row) for row in rows)


def texts(path):
    return duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet/*.parquet'").fetchall()


@pytest.fixture(scope="module")
def small_dir(spark, sf_dir, tmp_path_factory):
    """The given tables, in folders like those of the other fixtures."""
    path = tmp_path_factory.mktemp("given")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(params=["small_dir", "odd_dir", "empty_dir"])
def any_dir(request):
    return request.getfixturevalue(request.param)


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) - {"op10_line_dedup"}))
def test_equals_sql(spark, any_dir, name):
    columns, rows = run(spark, name, any_dir)
    assert bag(rows) == bag(by_sql(any_dir, ORACLE_SQL[name], columns))


def by_sql(path, sql, columns):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    return con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()


@pytest.mark.parametrize("crowd", [50, 2])
def test_line_dedup_equals_sql(spark, small_dir, monkeypatch, crowd):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    columns, rows = run(spark, "op10_line_dedup", small_dir)
    assert bag(rows) == bag(by_sql(small_dir, ORACLE_SQL["op10_line_dedup"], columns))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, odd_dir, empty_dir, name):
    columns, rows = run(spark, name, odd_dir)
    table = "pages" if "page_id" in columns else "documents"
    if not name.startswith(("op4_", "op11_", "op13_")):
        expected = spark.read.parquet(f"{odd_dir}/{table}.parquet").count()
        assert len(rows) == expected
    assert run(spark, name, empty_dir)[1] == []


# --- substring dedup ------------------------------------------------------------


def passages_by_force(rows):
    first, result = {}, []
    known = sorted({(d, t) for d, t in rows if d is not None}, key=lambda r: r[0])
    for d, t in known:
        w = words(t)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            first[key] = min(first.get(key, (d, i)), (d, i))
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 19 if d is not None else 0):
            if first[tuple(w[i : i + 20])] < (d, i):
                gone[i : i + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        result.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return result


@pytest.mark.parametrize("salt_rows", [50_000, 2])
def test_substring_dedup_by_force(spark, any_dir, monkeypatch, salt_rows):
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", salt_rows)
    _, rows = run(spark, "op2_substring_dedup", any_dir)
    assert bag(rows) == bag(passages_by_force(texts(any_dir)))


def test_rows_that_repeat_a_row_are_one_document(spark, monkeypatch):
    seen = []
    original = substring_dedup.located

    def counted(found, by, bits=None):
        seen.append(found.count())
        return original(found, by, bits)

    monkeypatch.setattr(substring_dedup, "located", counted)
    rows = [(1, PROSE_WORDS), (2, "other words first " + PROSE_WORDS)] + [(3, PROSE_WORDS + " end")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in substring_dedup.remove_passages(docs).select("doc_id", "n_words", "n_removed").collect()]
    expected = [r[:3] for r in passages_by_force(rows)]
    assert Counter(found) == Counter(expected)
    assert seen[0] < 100


PROSE_WORDS = " ".join(f"p{i}" for i in range(60))


def test_an_anchor_with_many_surroundings_is_held_as_hashes():
    """Windows that do not recur never become words of an automaton."""
    rng = random.Random(3)
    shard = []
    for i in range(20_000):
        around = [b"w%d" % rng.randrange(10**6) for _ in range(27)]
        around[11:16] = [b"the", b"same", b"five", b"words", b"here"]
        shard.append((i, i, 1, 0, b" ".join(around)))
    shard += [(30_000, 1, 1, 5, shard[7][4]), (30_001, 2, 1, 9, shard[7][4])]
    tracemalloc.start()
    found = substring_dedup.locate(shard)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found) == [(30_000, 1, 5, 32, None), (30_001, 2, 9, 36, None)]
    assert peak < 120e6


# --- line dedup -----------------------------------------------------------------


def test_crowds_of_long_lines_are_told_apart(spark):
    """62 lines of 20,000 characters that differ in one in the middle, and some that lack
    or have one more there."""
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh ", k=20_000))
    letters = "".join(map(chr, range(48, 110)))  # 62 of them
    lines = [base[:9_999] + c + base[10_000:] for c in letters]
    lines += [base[:9_999] + base[10_000:], base[:9_999] + "zz" + base[10_000:], base[:5] + "Z" + lines[0][5:]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    start = time.perf_counter()
    found = {r.doc_id: (r.n_links, r.n_removed) for r in line_dedup.dedup(docs).collect()}
    assert time.perf_counter() - start < 60
    n = len(letters)
    expected = {}
    for i, x in enumerate(lines):
        links = [j for j, y in enumerate(lines) if i != j and one_edit(x, y)]
        expected[i] = (len(links), int(any(j < i for j in links)))
    assert expected[0] == (n - 1 + 2, 0)
    assert found == expected


@pytest.mark.parametrize("crowd", [0, 3])
def test_crowds_by_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    rng = random.Random(9)
    lines = sorted({"".join(rng.choices("ab", k=rng.randrange(2, 7))) for _ in range(60)})
    lines += [f"line number {i} of them" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id: r.n_links for r in line_dedup.dedup(docs).collect()}
    assert found == {
        i: sum(1 for j, y in enumerate(lines) if i != j and one_edit(x, y)) for i, x in enumerate(lines)
    }


def one_edit(a, b):
    short, long = sorted((a, b), key=len)
    start = next((i for i, c in enumerate(short) if c != long[i]), len(short))
    return short[start + len(short) - len(long) + 1 :] == long[start + 1 :] and (
        len(long) - len(short) < 2
    )


def test_crowded_segments(spark):
    """Lines that mostly differ from one another by two edits, and share every half."""
    lines = [f"chapter {i:03d} of the very same long book, part {j}" for i in range(90) for j in "ab"]
    lines += [f"chapter {i:02d} of the very same long book, part a" for i in range(30)]
    rows = [(i, line) for i, line in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_links) for r in line_dedup.dedup(docs).collect()}
    for i, a in enumerate(lines):
        near = [j for j, b in enumerate(lines) if a != b and one_edit(a, b)]
        assert got[i] == (int(any(j < i for j in near)), len(near)), a


# --- near dedup -----------------------------------------------------------------


def components_by_force(rows, percent):
    sets = defaultdict(set)
    for d, t in rows:
        if d is not None:
            w = (t or "").encode().lower().split()
            sets[d] |= {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            low, high = sorted((len(sets[a]), len(sets[b])))
            if 100 * low >= percent * high:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (low + high - shared):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("crowd", [50, 2])
def test_near_dedup_by_force(spark, any_dir, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    _, rows = run(spark, "op9_near_dedup", any_dir)
    given = texts(any_dir)
    expected = components_by_force(given, 85)
    assert len(rows) == len(given)
    for doc_id, n, component, kept in rows:
        if doc_id is None:
            assert component is None and kept
        else:
            assert (n, component) == expected[doc_id]
            assert kept == (doc_id == component)


@pytest.mark.parametrize("crowd", [50, 5])
def test_near_dedup_compares_across_components(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    """A chain of near copies, of which no hub is close to all."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        w = [f"c{j}" if j < 4 * i else x for j, x in enumerate(base)]
        rows.append((i, " ".join(w)))
    df = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}
    assert got == components_by_force(rows, 85)


def test_near_dedup_of_a_large_group_around_the_threshold(spark):
    """Copies with one to sixty edits: some near the original, some near one another."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        w = list(base[: 300 - rng.choice([0, 0, 40, 60])])
        for at in rng.sample(range(200), rng.randrange(1, 13)):
            w[at] = f"e{i if i % 3 else 0}x{at}"
        rows.append((i, " ".join(w)))
    df = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}
    assert got == components_by_force(rows, 85)


def test_components_by_force(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(400 + i, 401 + i) for i in range(40)] + [(500, i) for i in range(501, 540)]
    least = {n: n for link in links for n in link}
    for _ in least:
        for x, y in links:
            least[x] = least[y] = min(least[x], least[y])
    found = components.components(spark.createDataFrame(links, "x long, y long"))
    assert sorted(found.collect()) == sorted((n, m) for n, m in least.items() if n != m)


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Components that are found already are not worked out again."""
    names = []
    monkeypatch.setattr(
        components, "written", lambda df, name: names.append(name) or written(df, name)
    )
    links = [(5, 1), (6, 1), (2, 7), (2, 8), (9, 9)]
    found = components.components(spark.createDataFrame(links, "x long, y long"))
    assert sorted(found.collect()) == [(5, 1), (6, 1), (7, 2), (8, 2)]
    assert len(names) == 1


def test_a_sketch_does_not_hold_the_whole_set():
    """A batch of sketches must not keep the hashes of all its texts in memory."""
    values = near_dedup.shingles(" ".join(map(str, range(5000))))
    kept = near_dedup.smallest(values, near_dedup.SKETCH)
    assert kept.tolist() == values[: near_dedup.SKETCH].view("int64").tolist()
    assert kept.base is None


def test_sketches_hardly_ever_miss():
    assert near_dedup.chance_of_a_miss(0.85) < 1e-7
    assert near_dedup.chance_of_a_miss(0.80) < 1e-5


# --- mixing ---------------------------------------------------------------------


def test_mixing(spark, any_dir):
    columns, rows = run(spark, "op7_mixing", any_dir)
    given = duckdb.sql(
        f"SELECT doc_id, text, source FROM '{any_dir}/documents.parquet/*.parquet'"
    ).fetchall()
    sizes = defaultdict(int)
    for _, text, source in given:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order]), strict=True))
    assert bag((d, len(words(t)), sizes[s], wanted[s]) for d, t, s in given) == bag(
        r[:4] for r in rows
    )
    by_target = defaultdict(lambda: [0, 0])
    for _, size, source_size, target, taken, *_ in rows:
        assert 0 <= taken <= 3 * size
        by_target[(source_size, target)][0] += taken
    for (size, target), (taken, _) in by_target.items():
        sources = sum(1 for s in sizes if (sizes[s], wanted[s]) == (size, target))
        assert abs(taken - sources * target) <= mixing.BLOCK * sources
    again = QUERIES["op7_mixing"](spark, any_dir).repartition(5)
    assert bag(tuple(r) for r in again.collect()) == bag(rows)


def test_targets_stop_and_are_reshared():
    # Weights 1, 2, 3: the third source stops at 3 * 10, the rest goes to the others.
    assert mixing.targets([300, 290, 10]) == [190.0, 380.0, 30.0]
    assert mixing.targets([0, 0]) == [0.0, 0.0]
    assert mixing.targets([]) == []


def test_splitting_tree_is_exact_and_fair():
    quotas = mixing.split_quotas([1000, 50_000, 0, 3], 7)
    assert quotas.sum(axis=0).tolist() == [1000, 50_000, 0, 3]
    assert quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= 7
    large = mixing.split_quotas([10**12, 3], 4)
    assert large.sum(axis=0).tolist() == [10**12, 3]


def test_mix_holds_the_blocks_it_counts(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    rows = mixing.mix(docs, shards=5).collect()
    taken = sum(r[4] for r in run(spark, "op7_mixing", odd_dir)[1])
    assert sum(len(words(r.text)) for r in rows) == taken
    assert {r.shard for r in rows} == set(range(5))
    counts = Counter(r.shard for r in rows).values()
    assert max(counts) - min(counts) <= 5
    by_doc = {r[0]: words(r[1]) for r in texts(odd_dir) if r[0] not in (2, None)}
    for r in rows:
        if r.doc_id in by_doc:
            begin = r.block * mixing.BLOCK
            assert words(r.text) == by_doc[r.doc_id][begin : begin + mixing.BLOCK]


def test_mixing_by_a_sequential_deal(spark, monkeypatch):
    """One order of blocks per source, dealt by hand to the shards by the tree's quotas."""
    monkeypatch.setattr(mixing, "RANGE", 7)
    rows = [(i, f"w{i} " * (150 * i % 1900), "abc"[i % 5 % 3]) for i in range(60)]
    rows += [(100, "again " * 300, "b")] * 25 + [(101, None, None), (102, "x " * 700, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = ["a", "b", "c", None]
    sizes = [sum(len(words(t)) for _, t, s in rows if s == source) for source in order]
    copies, blocks = Counter(), []
    for doc_id, text, source in rows:
        copies[doc_id] += 1
        size = len(words(text))
        for block in range(-(-size // mixing.BLOCK)):
            blocks.append((doc_id, text, size, copies[doc_id], block, order.index(source)))
    placed = spark.createDataFrame(
        blocks, "doc_id long, text string, size long, copy long, block int, source_no long"
    ).selectExpr(
        "source_no", "xxhash64(1, doc_id, xxhash64(text), size, copy, block, source_no) AS place",
        "doc_id", "copy", "block", "size",
    ).collect()
    draws = []
    for no, target in enumerate(mixing.targets(sizes)):
        ranked = sorted((r for r in placed if r.source_no == no), key=lambda r: r.place)
        passes, own, before = int(target // sizes[no]), [], 0
        for r in ranked:
            n = min(mixing.BLOCK, r.size - r.block * mixing.BLOCK)
            own.append((r, n, passes + (before + n / 2 <= target - passes * sizes[no])))
            before += n
        draws.append([(r, n, k) for k in range(passes + 1) for r, n, d in own if d > k])
    quotas = mixing.split_quotas([len(d) for d in draws], 5)
    expected, taken = [], Counter()
    for no, own in enumerate(draws):
        shards = [shard for shard in range(5) for _ in range(quotas[shard][no])]
        for (r, n, k), shard in zip(own, shards, strict=True):
            expected.append((r.doc_id, r.copy, r.block, k, shard))
            taken[r.doc_id, r.copy] += n
    found = mixing.drawn_blocks(docs, 5).filter("pass IS NOT NULL")
    columns = ["doc_id", "copy", "block", "pass", "shard"]
    assert bag(tuple(r) for r in found.select(columns).collect()) == bag(expected)
    by_doc = defaultdict(set)
    for doc_id, _, _, _, shard in expected:
        by_doc[doc_id].add(shard)
    result = mixing.taken(docs, 5).collect()
    assert len(result) == len(rows) and len(by_doc) > 50
    assert sum(r.taken for r in result) == sum(taken.values())
    for r in result:
        shards = by_doc.get(r.doc_id)
        assert (r.first_shard is None) == (r.dealt is None) == (r.taken == 0)
        if copies[r.doc_id] == 1 and shards:
            assert (r.first_shard, r.last_shard) == (min(shards), max(shards))
            assert r.taken == taken[r.doc_id, 1]


def test_documents_without_words_are_not_ranked(spark):
    """They have no block, so the number of ranges does not allow for them."""
    rows = [(i, " ", "a") for i in range(500)] + [(1000, "some words", "a"), (1001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.units(docs)
    ranked = mixing.ranked_blocks(sized, mixing.source_table(sized), 1)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "(size#" in plan.split("Window [")[-1] and "> 0)" in plan.split("Window [")[-1]
    found = ranked.collect()
    assert len(found) == 502 and sum(r.draws > 0 for r in found) == 1
    taken = {r.doc_id: r.taken for r in mixing.taken(docs).collect()}
    assert len(taken) == 502 and [d for d, n in taken.items() if n] == [1000]


# --- decontamination ------------------------------------------------------------


@pytest.mark.parametrize("items", [60, 1])
def test_items_in_blocks(spark, odd_dir, monkeypatch, items):
    """The blocks of the query set do not change the result, nor are documents rewritten."""
    docs, bench = (spark.read.parquet(f"{odd_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = bag(tuple(r) for r in decontamination.matches(docs, bench).collect())
    kept = bag(tuple(r) for r in decontamination.decontaminated(docs, bench).collect())
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", items)
    rows = []
    original = decontamination.written

    def counted(df, name):
        result = original(df, name)
        rows.append((set(result.columns), result.count()))
        return result

    monkeypatch.setattr(decontamination, "written", counted)
    assert bag(tuple(r) for r in decontamination.matches(docs, bench).collect()) == whole
    assert bag(tuple(r) for r in decontamination.decontaminated(docs, bench).collect()) == kept
    assert all("text" not in columns and n <= len(whole) for columns, n in rows)
    assert bool(rows) == (items == 1)


def test_reserved_names_are_free_to_use(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").selectExpr(
        "doc_id", "text", "lang", "1 AS _items", "2 AS _toxicity", "'x' AS __toxicity"
    )
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "decontamination"):
        out = stages[name](spark, docs, odd_dir)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select("_items", "_toxicity", "__toxicity").collect()} == {(1, 2, "x")}


def test_items_without_id_and_very_long_items(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    assert len(long) > 1_000_000
    item = "an item of these seven words here"
    items = spark.createDataFrame([(None, item), (2, item), (3, long)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"so {item} ends"), (2, f"so {long} ends"), (3, "neither")], "doc_id long, text string"
    )
    found = [tuple(r) for r in decontamination.matches(docs, items).collect()]
    assert bag(found) == bag([(1, None, 3, 3), (1, 2, 3, 3), (2, 3, 199_996, 199_996)])
    kept = decontamination.decontaminated(docs, items.filter("item_id IS DISTINCT FROM 2"))
    assert [r.doc_id for r in kept.collect()] == [3]


def test_signatures_leave_nothing_out():
    for size in range(1, 100):
        signature = min(decontamination.partition_signature(size), size)
        lacking = size - -(-8 * size // 10)
        assert signature > lacking or signature == decontamination.SIGNATURE


# --- pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark, any_dir):
    docs = spark.read.parquet(f"{any_dir}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, any_dir)
        assert docs.columns == columns, name
        rows = docs.select("doc_id", "text", "n_chars").collect()
        now = {r.doc_id for r in rows}
        assert now <= before, name
        before = now
        if name == "near_dedup":
            found = components_by_force([(r.doc_id, r.text) for r in rows], 80)
            assert all(component == d for d, (_, component) in found.items())
            known = [r.doc_id for r in rows if r.doc_id is not None]
            assert len(known) == len(set(known))
        if name == "decontamination":
            items = spark.read.parquet(f"{any_dir}/benchmark.parquet")
            assert decontamination.matches(docs, items).count() == 0
    mixture = corpus_pipeline.STAGES[-1][1](spark, docs, any_dir)
    assert {r.doc_id for r in mixture.select("doc_id").collect()} <= before


def test_pipeline_drops_what_each_stage_is_for(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)
    near = {r.doc_id for r in kept["near_dedup"](spark, docs, odd_dir).collect()}
    assert 1 in near and not near & {2, 3, 100, 120}
    clean = {r.doc_id for r in kept["decontamination"](spark, docs, odd_dir).collect()}
    assert 9 not in clean and {1, 4, 5, 13} <= clean
    lines = {r.doc_id: r.text for r in kept["line_dedup"](spark, docs, odd_dir).collect()}
    assert lines[201] == "own line 1 1" and lines[200].startswith("shared line here")
    assert lines[2] == lines[1]  # a copy as a whole is left to the next stage


def test_pipeline_carries_out_every_line_decision(spark, any_dir):
    docs = spark.read.parquet(f"{any_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").collect()
    first = {}
    for r in rows:
        first[r.text] = min(first.get(r.text, r.doc_id), r.doc_id)
    lost = {r.doc_id: set(r.repeats) for r in line_dedup.repeated_places(docs).collect()}

    def left(r):
        lines = enumerate(r.text.split("\n"))
        return "\n".join(x for n, x in lines if n not in lost.get(first[r.text], ()))

    stage = line_dedup.remove_repeats(docs)
    found = stage.filter("doc_id IS NOT NULL AND text IS NOT NULL").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, left(r)) for r in rows)
    # Exact copies get the text of the first one, so the next stage drops all of them.
    near = {r.doc_id for r in near_dedup.deduplicated(stage, corpus_pipeline.SIMILARITY).collect()}
    copies = {r.doc_id for r in rows if first[r.text] < r.doc_id and left(r).strip()}
    assert not copies & near
