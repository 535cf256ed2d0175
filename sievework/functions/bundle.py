"""Scenes made to stand alone: sibling files inlined, helpers bundled, imports inferred, paths and local imports cleaned."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.fixes import without_path_hacks
from sievework.functions.pycode import parse

_STAR = "from manim import *"
#: Names whose use asks for an import.
IMPORTS = (
    (("np", "numpy"), ("import numpy as np",)),
    (("nx", "networkx"), ("import networkx as nx",)),
    (tuple("ceil cos exp floor log pi sin sqrt tan".split()), ("import math", "from math import *")),
    (tuple("choice randint random seed shuffle uniform".split()), ("import random", "from random import *")),
)
#: Libraries of a helper file's own imports, kept where one of the names is used (always: no names).
KEPT_IMPORTS = {"pulp": ("LpProblem", "LpVariable", "lpSum"), "yaml": ("load", "dump"), "functools": ("partial", "reduce"), "itertools": ("combinations", "permutations", "product"), "typing": ()}


class _Inliner(ast.NodeTransformer):
    """Reads of known files become their content: through open(...) itself, a variable, or a with block."""

    def __init__(self, files: Mapping[str, str], names: Mapping[str, str]) -> None:
        self.files, self.names, self.inlined = files, names, []
        self.handles: dict[str, str] = {}

    def _path(self, node: ast.expr) -> str | None:
        match node:
            case ast.Constant(value=str(name)):
                return name
            case ast.Name(id=name):
                return self.names.get(name)
            case ast.BinOp(left=left, op=ast.Div(), right=right) if (a := self._path(left)) and (b := self._path(right)):
                return f"{a.rstrip('/')}/{b}"
            case ast.Call(func=ast.Name(id="Path"), args=[only]):
                return self._path(only)
        return None

    def _opened(self, node: ast.expr) -> str | None:
        """The known file that open(...) or a handle's name reads."""
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "open" and node.args:
            name = self._path(node.args[0])
        else:
            name = self.handles.get(node.id) if isinstance(node, ast.Name) else None
        return name if name in self.files else None

    def visit_Call(self, node: ast.Call) -> ast.AST:
        if isinstance(node.func, ast.Attribute) and node.func.attr in ("read", "readlines") and (name := self._opened(node.func.value)):
            self.inlined.append(name)
            text = self.files[name]
            return ast.Constant(text) if node.func.attr == "read" else ast.List([ast.Constant(x) for x in text.splitlines(True)], ast.Load())
        return self.generic_visit(node)

    def visit_Assign(self, node: ast.Assign) -> ast.AST | None:
        if len(node.targets) == 1 and isinstance(node.targets[0], ast.Name) and isinstance(node.value, ast.Call) and (name := self._opened(node.value)):
            self.handles[node.targets[0].id] = name
            return None
        return self.generic_visit(node)

    def visit_With(self, node: ast.With) -> ast.AST | list[ast.stmt]:
        if len(node.items) == 1 and isinstance(node.items[0].optional_vars, ast.Name) and (name := self._opened(node.items[0].context_expr)):
            self.handles[node.items[0].optional_vars.id] = name
            out: list[ast.stmt] = []
            for done in map(self.visit, node.body):
                out += done if isinstance(done, list) else [done] if done is not None else []
            return out
        return self.generic_visit(node)


def inline_files(code: str, files: Mapping[str, str]) -> tuple[str, list[str]]:
    """Code without reads of the known files (name: content), and the files' names; other code stays as it is.

    Handles that are only read are dropped with their open calls; code that uses a handle otherwise, or does not
    parse, stays.
    """
    tree, _ = parse(code)
    if tree is None:
        return code, []
    names = {n.targets[0].id: n.value.value for n in ast.walk(tree) if isinstance(n, ast.Assign) and len(n.targets) == 1 and isinstance(n.targets[0], ast.Name) and isinstance(n.value, ast.Constant) and isinstance(n.value.value, str)}
    change = _Inliner(files, names)
    done = ast.fix_missing_locations(change.visit(tree))
    left = {n.id for n in ast.walk(done) if isinstance(n, ast.Name)} & change.handles.keys()
    return (code, []) if not change.inlined or left else (ast.unparse(done), list(dict.fromkeys(change.inlined)))


def inline_code(code: Column, files: Column) -> Column:
    """Struct (code, inlined) for a code column and a map<string, string> of its sibling files."""

    @F.arrow_udf("struct<code: string, inlined: array<string>>")
    def run(codes: pa.Array, maps: pa.Array) -> pa.Array:
        rows = [None if c is None else dict(zip(("code", "inlined"), inline_files(c, dict(m or ())), strict=True)) for c, m in zip(codes.to_pylist(), maps.to_pylist(), strict=True)]
        return pa.array(rows, pa.struct([("code", pa.string()), ("inlined", pa.list_(pa.string()))]))

    return run(code, files)


def used_names(code: str) -> set[str]:
    tree, _ = parse(code)
    return set() if tree is None else {n.id for n in ast.walk(tree) if isinstance(n, ast.Name)}


def required_imports(code: str, utilities: str = "") -> list[str]:
    """Imports that code bundled from a helper file needs, by the names it uses; the star import comes first."""
    names = used_names(code)
    out = [_STAR]
    for words, lines in IMPORTS:
        if names & set(words):
            out += lines
    tree, _ = parse(utilities)
    for node in ast.walk(tree) if tree else ():
        if isinstance(node, (ast.Import, ast.ImportFrom)):
            line = ast.unparse(node)
            if any(lib in line and (not words or names & set(words)) for lib, words in KEPT_IMPORTS.items()):
                out.append(line)
    return list(dict.fromkeys(out))


def merged_methods(code: str) -> str:
    """Classes with each method once: the last definition stands, as in Python, and takes what an earlier one without arguments did.

    Where both an argument-less and another `__init__` are there, the arguments of the last become optional; methods
    that end in an open branch with nothing but `pass` stay. Code that does not parse stays as it is.
    """
    tree, _ = parse(code)
    if tree is None:
        return code
    changed = False
    for cls in [n for n in ast.walk(tree) if isinstance(n, ast.ClassDef)]:
        methods: dict[str, list[ast.FunctionDef]] = {}
        for f in cls.body:
            if isinstance(f, ast.FunctionDef):
                methods.setdefault(f.name, []).append(f)
        for name, all_of in methods.items():
            if len(all_of) < 2:
                continue
            changed, last = True, all_of[-1]
            cls.body = [x for x in cls.body if x not in all_of[:-1]]
            if name == "__init__" and len(all_of[0].args.args) == 1 and len(last.args.args) > 1 and not last.args.defaults:
                own = [a.arg for a in last.args.args[1:]]
                last.args.defaults = [ast.Constant(None) for _ in own]
                last.body = [*all_of[0].body, ast.If(ast.Name(own[0], ast.Load()), last.body, [])]
    return ast.unparse(ast.fix_missing_locations(tree)) if changed else code


def bundle_helpers(scene: str, helpers: Iterable[tuple[str, str]], head: str = f"{_STAR}\nfrom random import sample") -> str:
    """The scene below its helper files (name, content), each without imports and comment lines, under a header line."""
    parts = [head, ""]
    for name, content in helpers:
        kept = [x for x in merged_methods(content).split("\n") if not x.strip() or not x.strip().startswith(("import ", "from ", "#"))]
        if any(x.strip() for x in kept):
            parts += [f"# === {name} utility code ===", *kept, ""]
    return "\n".join([*parts, "# === Scene class ===", scene])


def clean_code(code: str, notes: Mapping[str, str] | None = None) -> str:
    """Code without path insertions, with the star import, and local imports (text: note) turned into comments."""
    code = without_path_hacks(code)
    if _STAR not in code:
        code = f"{_STAR}\n\n{code}"
    for text, note in (notes or {}).items():
        code = code.replace(text, f"# Note: {note}")
    return code.strip()


def clean_code_column(code: Column, notes: Mapping[str, str] | None = None) -> Column:
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else clean_code(x, notes) for x in column.to_pylist()], pa.string())

    return run(code)


def described_by_path(path: Column, name: Column, topics: Mapping[str, str] | None = None, part: int = 1) -> Column:
    """A description from a file's path below its tree and the scene's name: the topic's text where the map has one."""
    topic = F.coalesce(F.nullif(F.get(F.split(path, "/"), F.lit(part)), F.lit("")), F.lit("General"))
    known = F.create_map(*(F.lit(x) for kv in topics.items() for x in kv)) if topics else F.create_map().cast("map<string,string>")
    return F.coalesce(F.concat(F.try_element_at(known, topic), F.lit(" - "), name), F.concat(F.lit("Animation of "), name, F.lit(" from the "), topic, F.lit(" video")))


def narrated(code: Column, shown: int = 3, most: int = 150) -> Column:
    """A description from the first narration comments of a converted scene, cut to `most` characters; null without any."""
    told = F.regexp_extract_all(code, F.lit(r"(?m)^\s*# Narration: (.+)$"), F.lit(1))
    text = F.array_join(F.slice(told, 1, shown), " ")
    return F.when(F.size(told) > 0, F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text))


def stubs(code: str, classes: Mapping[str, str]) -> str:
    """Stand-in definitions (class name: source) for the classes that the code uses and does not define, above its first class."""
    tree, _ = parse(code)
    defined = set(re.findall(r"(?m)^class\s+(\w+)", code)) if tree is None else {n.name for n in ast.walk(tree) if isinstance(n, ast.ClassDef)}
    used = set(re.findall(r"\b[A-Za-z_]\w*\b", code)) if tree is None else used_names(code)
    wanted = [source for name, source in classes.items() if name in used and name not in defined]
    if not wanted:
        return code
    at = re.search(r"(?m)^class\s", code)
    cut = at.start() if at else len(code)
    return code[:cut] + "\n\n".join(wanted) + "\n\n\n" + code[cut:]
