"""The entry point without the optional part."""

import builtins
import sys

import __spark_entry__ as E
from medalake import catalog


def test_main_queries_survive_a_part_that_cannot_be_imported(monkeypatch):
    """A library that only the optional part needs is missing, or the part itself is."""
    real = builtins.__import__
    for missing in ("public_tokenizers", "medalake.llm"):
        for name in [m for m in sys.modules if m.startswith(("medalake.llm", "corpus_pipeline"))]:
            monkeypatch.delitem(sys.modules, name)

        def refuse(name, *args, missing=missing, **kwargs):
            if name.startswith(missing):
                raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
            return real(name, *args, **kwargs)

        monkeypatch.setitem(sys.modules, missing, None)
        monkeypatch.setattr(builtins, "__import__", refuse)
        assert set(E.queries()) == set(catalog.queries()) and set(E.oracle_sql()) == set(catalog.oracle_sql())
        monkeypatch.setattr(builtins, "__import__", real)
