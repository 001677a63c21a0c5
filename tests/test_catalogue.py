import __spark_entry__
import pytest

from lodestone.plans import catalogue, extended, reports, rules, state, travel  # noqa: F401  (they register their queries)
from tests.conftest import same_rows


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    if name in catalogue.SQL:
        same_rows(df, duck, catalogue.SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_says_what_it_covers():
    for name, f in catalogue.QUERIES.items():
        assert f.__doc__, name


def test_a_broken_dependency_is_an_error(monkeypatch):
    """Only the absence of the deletable parts is passed over."""
    import builtins
    import importlib

    real = builtins.__import__

    def without(*gone):
        def load(name, *args, **kwargs):
            if name.startswith(gone):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)
            return real(name, *args, **kwargs)

        return load

    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", without("lodestone.llm"))
        assert importlib.reload(__spark_entry__).llm is None and "gated_ticks" in __spark_entry__.queries()
    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", without("lodestone.plans"))
        with pytest.raises(ModuleNotFoundError):
            importlib.reload(__spark_entry__)
    importlib.reload(__spark_entry__)
