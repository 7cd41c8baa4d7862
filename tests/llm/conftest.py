"""Tables for the operators: small ones by hand, with every odd case, and empty ones."""

import os

import pytest
from pyspark.sql import types as T

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
PAGES = "page_id long, url string, html string"
BENCHMARK = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"

PROSE = " ".join(f"word{i} of tale{i % 37}" for i in range(60))
ITEM = "which of these nine colours does the old lighthouse keeper paint last"


def document_rows():
    rows = [
        (1, PROSE, "en", "a"),
        (2, PROSE, "en", "a"),
        (2, PROSE, "en", "a"),
        (3, PROSE + " and one more", "en", "b"),
        (4, None, "en", "b"),
        (5, "", None, None),
        (6, " \t\n\x0b ", "de", "c"),
        (7, "une seule ligne\nune seule ligne\nune seule ligna\n\n", "fr", "c"),
        (8, "word", "en", "b"),
        (None, PROSE, "en", None),
        (None, None, None, None),
        (9, f"before {ITEM.upper()} after", "en", "d"),
        (10, "12 34 -- 56", None, "d"),
        (11, "idiot moron scum " * 3, "en", "d"),
        (12, "naïve \U0001f600 café  x\x1cy", "fr", ""),
        # Very long: many words, one word, and one passage over and over.
        (13, " ".join(f"w{i * i % 9973}" for i in range(3000)), "en", "a"),
        (14, "x" * 30_000, None, "a"),
        (15, "again and again it says the same thing " * 300, "en", "d"),
    ]
    rows += [(100 + i, PROSE.replace("word7 ", f"edit{i} "), "en", "hot") for i in range(40)]
    rows += [(200 + i, f"shared line here\nown line {i} {i * i}", "de", "hot") for i in range(60)]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


PAGE_ROWS = [
    (1, "http://www.Example.NET/en/x?y#z", "<p>One &amp; two.</p>"),
    (1, "http://www.Example.NET/en/x?y#z", "<p>One &amp; two.</p>"),
    (2, "https://a.example.com/de/1", None),
    (3, "ftp://b.org/fr/2", ""),
    (4, "http://c.net", "<div><p>Not closed"),
    (5, "c.net/en/", "no markup"),
    (6, None, "<!-- never closed <p>x</p>"),
    (7, "", "<script>if (a < b) { x = '</p>' }</script><b>bold</b>"),
    (8, "http://shop.example.com/login/", "<p>" + "long text. " * 3_000 + "</p>"),
    (None, "http://c.net/", "<ul><li>a<li>b</ul>"),
]


def write_tables(spark, path, documents, pages, items, labels, extra=()):
    tables = {
        "documents": spark.createDataFrame(documents, DOCUMENTS),
        "pages": spark.createDataFrame(pages, PAGES),
        "benchmark": spark.createDataFrame(items, BENCHMARK),
        "labels": spark.createDataFrame(labels, LABELS),
    }
    for name, df in tables.items():
        for column in extra:
            df = df.selectExpr("*", f"'clash' AS {column}")
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


ODD_ITEMS = [(1, ITEM), (2, "two words"), (3, None), (4, ""), (1, "another lighthouse item")]
ODD_LABELS = [(11, 0, 1), (1, 1, 0), (3, 1, 0), (None, 1, 1), (13, None, None), (9, 1, 0)]
# Names that the operators use inside.
CLASHING = (
    "key host words rank value node component line sketch raw anchor size copy shard score path "
    "items toxicity place token matched n x y a b salt start block"
).split()


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")
    return write_tables(
        spark, path, document_rows(), PAGE_ROWS, ODD_ITEMS, ODD_LABELS, CLASHING
    )


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
