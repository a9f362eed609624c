"""The core stands without the subpackage of training-data operators."""

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_imports_llm():
    for p in (ROOT / "textmill").rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_entry_has_the_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 70
