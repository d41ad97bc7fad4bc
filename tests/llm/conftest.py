import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from conftest_texts import TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    from adjudica.llm.shared import workers_find_package

    return workers_find_package(spark)


@pytest.fixture(scope="session")
def docs(llm):
    rows = [(i, t, "en", "s", 1, 2, 3, "k", "w", "n", None) for i, t in TEXTS]
    return llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, node int, key string, words string, id string, bands string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture
def sf_dir(llm, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, "it was seen by all of them there and so on it went"), (2, "one two"), (3, None), (4, ""), (None, "two"), (2, "one two")]
    llm.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pages = [(1, "https://A.example.com:80/x/y?q", "h"), (2, None, None), (3, "nonsense", ""), (4, "http://b.example.com", "h"), (5, "http://b.example.com", "h")]
    llm.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)
