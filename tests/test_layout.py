import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_text_corpus_package():
    for p in [*(ROOT / "tezaur").rglob("*.py"), *(ROOT / "tests").glob("*.py"), ROOT / "bench.py"]:
        if (ROOT / "tezaur" / "llm") in p.parents:
            continue
        for node in ast.walk(ast.parse(p.read_text(encoding="utf-8"))):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_entry_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
