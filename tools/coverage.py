"""Write COVERAGE.md: every SURVEY §2 operator ID → functions, registered queries, tests.

IDs are read from the start of docstrings (e.g. "J4: ...") in the package, the
query catalog and the test names, so the table follows the code."""

from __future__ import annotations

import ast
import glob
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
ID = re.compile(r"\b([SLJCAMRDGTU]\d{1,2})\b")


def ids_of(text: str) -> list[str]:
    head = (text or "").strip().split("\n")[0]
    m = re.match(r"^((?:[SLJCAMRDGTU]\d{1,2}(?:[–-][SLJCAMRDGTU]?\d{1,2})?[,+ /(]*(?:and|aggregate)?\s*)+)", head)
    if not m:
        return []
    out = []
    for part in re.findall(r"([SLJCAMRDGTU])(\d{1,2})(?:[–-]([SLJCAMRDGTU]?)(\d{1,2}))?", m.group(1)):
        letter, a, _, b = part
        if b:
            out += [f"{letter}{i}" for i in range(int(a), int(b) + 1)]
        else:
            out.append(f"{letter}{a}")
    return out


def main() -> None:
    funcs: dict[str, list[str]] = {}
    for path in sorted(glob.glob(os.path.join(ROOT, "tessera", "**", "*.py"), recursive=True)):
        if "/plans/q_" in path:
            continue
        mod = os.path.relpath(path, ROOT)[:-3].replace("/", ".")
        for node in ast.walk(ast.parse(open(path).read())):
            if isinstance(node, ast.FunctionDef) and not node.name.startswith("_"):
                for i in ids_of(ast.get_docstring(node) or ""):
                    funcs.setdefault(i, []).append(f"`{mod}.{node.name}`")
    from tessera.plans.catalog import load_all
    queries: dict[str, list[str]] = {}
    for name, e in load_all().items():
        for i in ids_of(e.doc):
            queries.setdefault(i, []).append(f"`{name}`" + ("" if e.sql else " (no SQL oracle)"))
    tests: dict[str, list[str]] = {}
    for path in sorted(glob.glob(os.path.join(ROOT, "tests", "test_*.py"))):
        src = open(path).read()
        for node in ast.walk(ast.parse(src)):
            if isinstance(node, ast.FunctionDef) and node.name.startswith("test_"):
                for m in re.finditer(r"(?:^|_)([sljcamrdgtu]\d{1,2})(?=_|$)", node.name):
                    tests.setdefault(m.group(1).upper(), []).append(f"`{os.path.basename(path)}::{node.name}`")
    gate_src = open(os.path.join(ROOT, "tests", "test_oracle_gate.py")).read()
    gated = set(re.findall(r'"([a-z]\d+_\w+)"', gate_src))
    for name, e in load_all().items():
        if name in gated:
            for i in ids_of(e.doc):
                tests.setdefault(i, []).append(f"`test_oracle_gate[{name}]`")
    order = "SLJCAMRDGTU"
    all_ids = sorted(set(funcs) | set(queries) | set(tests), key=lambda x: (order.index(x[0]), int(x[1:])))
    lines = ["# COVERAGE — SURVEY §2 operator IDs in this repository", "",
             "Generated by `python tools/coverage.py` from docstrings and test names.", "",
             "| ID | Functions | Registered queries | Tests |", "|---|---|---|---|"]
    for i in all_ids:
        lines.append(f"| {i} | {', '.join(funcs.get(i, [])) or '—'} | {', '.join(queries.get(i, [])) or '—'} | "
                     f"{', '.join(tests.get(i, [])) or '—'} |")
    with open(os.path.join(ROOT, "COVERAGE.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print(len(all_ids), "ids")


if __name__ == "__main__":
    main()
