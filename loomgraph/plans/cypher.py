"""A Cypher subset compiled to DataFrames over nodes and edges.

MATCH with chains of (variable:Label)-[:TYPE]->(variable), either direction, -[:TYPE*1..]-> for paths; WHERE with AND, comparisons, IN, IS NULL,
IS NOT NULL, STARTS WITH, CONTAINS; UNWIND labels(n) AS x; WITH x, count(n) AS y; RETURN [DISTINCT] expressions AS names; ORDER BY, SKIP, LIMIT.
A path stands for the pairs that it connects, each once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.closure import transitive

_TOKEN = re.compile(r"""\s+|//[^\n]*|(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+(?:\.\d+)?)|(?P<word>[A-Za-z_]\w*)|(?P<mark><-|->|<>|<=|>=|\.\.|[()\[\]{}:,.*=<>|-])""")


class CypherError(ValueError):
    """Text that is not of the subset."""


class _Run:
    def __init__(self, text: str, nodes: DataFrame, edges: DataFrame, external: DataFrame | None):
        self.tokens, at = [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise CypherError(f"no Cypher at {text[at : at + 20]!r}")
            if m.lastgroup:
                self.tokens.append((m.lastgroup, m[0]))
            at = m.end()
        self.tokens.append(("end", ""))
        self.i = 0
        self.nodes, self.edges = nodes, edges
        if external is not None:  # nodes without labels, known by their URI
            uris = external.select(F.col("uri").alias("entityId"), F.array(F.lit("External")).alias("labels"), "uri").distinct()
            self.nodes = nodes.unionByName(uris, allowMissingColumns=True)
            self.edges = edges.unionByName(external.select("src", F.lit("SAME_AS").alias("type"), F.col("uri").alias("dst")))
        self.df: DataFrame | None = None
        self.vars: set[str] = set()
        self.anonymous = 0

    def now(self) -> str:
        return self.tokens[self.i][1]

    def word(self, *words: str) -> bool:
        if self.now().upper() in words and self.tokens[self.i][0] == "word":
            self.i += 1
            return True
        return False

    def mark(self, m: str) -> bool:
        if self.tokens[self.i] == ("mark", m):
            self.i += 1
            return True
        return False

    def need(self, m: str) -> None:
        if not self.mark(m):
            raise CypherError(f"{m} expected, {self.now()!r} found")

    def name(self) -> str:
        self.i += 1
        return self.tokens[self.i - 1][1]

    def node(self) -> str:
        """A node pattern joined to the rows so far; its variable."""
        self.need("(")
        self.anonymous += 1
        var = self.name() if self.tokens[self.i][0] == "word" else f"_n{self.anonymous}"
        labels = []
        while self.mark(":"):
            labels.append(self.name())
        self.need(")")
        self.wanted.append((var, labels))
        return var

    def pattern(self) -> None:
        self.wanted: list[tuple[str, list[str]]] = []
        hops = []
        left = self.node()
        while self.now() in ("-", "<-"):
            back = self.mark("<-")
            if not back:
                self.need("-")
            self.need("[")
            if self.tokens[self.i][0] == "word":
                self.i += 1
            kinds, path = [], False
            if self.mark(":"):
                kinds.append(self.name())
                while self.mark("|"):
                    kinds.append(self.name())
            if self.mark("*"):
                path = True
                if self.tokens[self.i][0] == "number" and self.name() != "1":
                    raise CypherError("paths start at one step")
                self.mark("..")
            self.need("]")
            self.need("-" if back else "->")
            right = self.node()
            hops.append((left, right, kinds, path, back))
            left = right
        for a, b, kinds, path, back in hops:
            e = self.edges.filter(F.col("type").isin(*kinds)) if kinds else self.edges
            pairs = transitive(e, "src", "dst") if path else e.select("src", "dst")
            self.join_ids(pairs.select(F.col("src").alias(b if back else a), F.col("dst").alias(a if back else b)))
        for var, labels in self.wanted:
            some = self.nodes
            for x in labels:
                some = some.filter(F.array_contains("labels", x))
            if not hops or labels:
                self.join_ids(some.select(F.col("entityId").alias(var)))

    def join_ids(self, ids: DataFrame) -> None:
        if self.df is None:
            self.df = ids
        else:
            shared = [c for c in ids.columns if c in self.df.columns]
            self.df = self.df.join(ids, shared) if shared else self.df.crossJoin(ids)
        self.vars |= set(ids.columns)

    def property(self, var: str, prop: str) -> Column:
        """The column of a node's property, joined in when first asked for."""
        if prop == "entityId":
            return F.col(var)
        col = f"_{var}_{prop}"
        if col not in self.df.columns:
            if prop not in self.nodes.columns:
                return F.lit(None).cast("string")
            self.df = self.df.join(self.nodes.select(F.col("entityId").alias(var), F.col(prop).alias(col)), var, "left")
        return F.col(col)

    def value(self) -> Column:
        kind, text = self.tokens[self.i]
        if kind == "string":
            self.i += 1
            return F.lit(re.sub(r"\\(.)", r"\1", text[1:-1]))
        if kind == "number":
            self.i += 1
            return F.lit(float(text) if "." in text else int(text))
        name = self.name()
        if self.mark("("):
            low = name.lower()
            if low == "labels":
                c = self.property(self.name(), "labels")
            elif low == "count":
                distinct = self.word("DISTINCT")
                c = F.count("*") if self.mark("*") else (F.count_distinct if distinct else F.count)(self.value())
            elif low == "tolower":
                c = F.lower(self.value())
            else:
                raise CypherError(f"no function {name}")
            self.need(")")
            return c
        if self.mark("."):
            return self.property(name, self.name())
        return F.col(name)

    def predicate(self) -> Column:
        out = self.comparison()
        while True:
            if self.word("AND"):
                out = out & self.comparison()
            elif self.word("OR"):
                out = out | self.comparison()
            else:
                return out

    def comparison(self) -> Column:
        if self.mark("("):
            c = self.predicate()
            self.need(")")
            return c
        if self.word("NOT"):
            return ~self.comparison()
        a = self.value()
        if self.word("IS"):
            no = self.word("NOT")
            self.word("NULL")
            return a.isNotNull() if no else a.isNull()
        if self.word("IN"):
            self.need("[")
            items = [self.value()]
            while self.mark(","):
                items.append(self.value())
            self.need("]")
            return a.isin(*items)
        if self.word("STARTS"):
            self.word("WITH")
            return F.startswith(a, self.value())
        if self.word("CONTAINS"):
            return F.contains(a, self.value())
        op = self.name()
        b = self.value()
        return {"=": a == b, "<>": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[op]

    def items(self) -> list[tuple[str, Column, bool]]:
        """name, column, whether it aggregates."""
        out = []
        while True:
            start = self.i
            c = self.value()
            text = "".join(t for _, t in self.tokens[start : self.i])
            grouped = text.lower().startswith("count(")
            out.append((self.name() if self.word("AS") else text, c, grouped))
            if not self.mark(","):
                return out

    def project(self) -> None:
        distinct = self.word("DISTINCT")
        items = self.items()
        keys, aggs = [(n, c) for n, c, g in items if not g], [c.alias(n) for n, c, g in items if g]
        if aggs:
            df = self.df.select("*", *[c.alias(f"_k_{n}") for n, c in keys]).groupBy(*[f"_k_{n}" for n, _ in keys]).agg(*aggs)
            self.df = df.select(*[F.col(f"_k_{n}").alias(n) if not g else F.col(n) for n, _, g in items])
        else:
            self.df = self.df.select(*[c.alias(n) for n, c in keys])
        if distinct:
            self.df = self.df.distinct()

    def run(self) -> DataFrame:
        while self.tokens[self.i][0] != "end":
            if self.word("MATCH"):
                self.pattern()
                while self.mark(","):
                    self.pattern()
            elif self.word("WHERE"):
                condition = self.predicate()
                self.df = self.df.filter(condition)
            elif self.word("UNWIND"):
                c = self.value()
                self.word("AS")
                self.df = self.df.withColumn(self.name(), F.explode(c))
            elif self.word("WITH", "RETURN"):
                self.project()
            elif self.word("ORDER"):
                self.word("BY")
                keys = []
                while True:
                    c = self.value()
                    down = self.word("DESC")
                    self.word("ASC")
                    keys.append(c.desc() if down else c.asc())
                    if not self.mark(","):
                        break
                self.df = self.df.orderBy(*keys)
            elif self.word("SKIP"):
                self.df = self.df.offset(int(self.name()))
            elif self.word("LIMIT"):
                self.df = self.df.limit(int(self.name()))
            else:
                raise CypherError(f"{self.now()!r} stands where it can't")
        return self.df


def run(text: str, nodes: DataFrame, edges: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """nodes: entityId, labels, properties; edges: src, type, dst; external: src, uri."""
    return _Run(text, nodes, edges, external).run()
