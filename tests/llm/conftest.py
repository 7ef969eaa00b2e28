import pytest

from daypanel.llm.frames import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, source)`` rows, over several partitions, with clashing extra columns."""
    def make(rows, parts=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, "y") for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, body string, "
                                           "key int, row string").repartition(parts)

    return make
