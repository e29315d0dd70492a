"""A SPARQL subset compiled to DataFrames over quads.

SELECT (DISTINCT, expressions, COUNT/SUM/AVG/MIN/MAX/SAMPLE, GROUP BY, HAVING, ORDER BY, LIMIT, OFFSET) and ASK; groups of triple patterns with ; and ,
lists, + and * paths, FILTER, OPTIONAL, UNION, GRAPH, VALUES, BIND and sub-groups.

A solution is a row with a struct column (k kind, v value, l language, d datatype; no nulls inside) for each variable; null is unbound. Patterns of
a group are joined most constants first and always along shared variables where there are any, so that patterns of one subject share a
partitioning. Variables that OPTIONAL or UNION may leave unbound are joined by compatibility, not by equality. The default graph is the distinct
union of the graphs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.closure import leading_to, transitive
from ..operators.rdf import RDF, XSD, union_graph

_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^<>\s]*>)|(?P<var>[?$]\w+)|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z-]+)|(?P<type>\^\^)
    |(?P<number>[+-]?\d+(?:\.\d+)?)|(?P<name>[A-Za-z_][\w-]*:[\w.-]*\w|[A-Za-z_][\w-]*:|:[\w-]+|:)|(?P<word>[A-Za-z_]+)|(?P<mark>&&|\|\||!=|<=|>=|[{}().;,=<>!*+/|-])""",
    re.X,
)
AGGREGATES = ("COUNT", "SUM", "AVG", "MIN", "MAX", "SAMPLE")


class SparqlError(ValueError):
    """Text that is not of the subset."""


@dataclass
class Group:
    """Parts of { } in order: ('triple', s, p, o, path), ('filter', e), ('optional', g), ('union', [g]), ('graph', term, g), ('values', vars, rows), ('bind', e, var), ('group', g)."""

    parts: list[tuple] = field(default_factory=list)


@dataclass
class Query:
    form: str = "SELECT"
    distinct: bool = False
    select: list[tuple] = field(default_factory=list)  # (name, expression or None); empty: *
    where: Group = field(default_factory=Group)
    group_by: list[str] = field(default_factory=list)
    having: list = field(default_factory=list)
    order: list[tuple] = field(default_factory=list)
    limit: int | None = None
    offset: int = 0


class _Parser:
    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise SparqlError(f"SPARQL_INVALID at {text[at : at + 30]!r}")
            if m.lastgroup:
                self.tokens.append((m.lastgroup, m[0]))
            at = m.end()
        self.tokens.append(("end", ""))
        self.i, self.prefix = 0, {}

    @property
    def now(self) -> tuple[str, str]:
        return self.tokens[self.i]

    def word(self, *words: str) -> bool:
        if self.now[0] == "word" and self.now[1].upper() in words:
            self.i += 1
            return True
        return False

    def peek(self, *words: str) -> bool:
        return self.now[0] == "word" and self.now[1].upper() in words

    def mark(self, m: str) -> bool:
        if self.now == ("mark", m):
            self.i += 1
            return True
        return False

    def need(self, m: str) -> None:
        if not self.mark(m):
            raise SparqlError(f"SPARQL_INVALID: {m} expected, {self.now[1]!r} found")

    def var(self) -> str:
        kind, v = self.now
        if kind != "var":
            raise SparqlError(f"SPARQL_INVALID: variable expected, {v!r} found")
        self.i += 1
        return v[1:]

    def term(self):
        """('var', name) or ('term', k, v, l, d)."""
        kind, v = self.now
        self.i += 1
        if kind == "var":
            return ("var", v[1:])
        if kind == "iri":
            return ("term", "iri", v[1:-1], "", "")
        if kind == "name":
            p, _, local = v.partition(":")
            if p not in self.prefix:
                raise SparqlError(f"SPARQL_INVALID: no prefix {p}:")
            return ("term", "iri", self.prefix[p] + local, "", "")
        if kind == "word" and v == "a":
            return ("term", "iri", RDF + "type", "", "")
        if kind == "word" and v.lower() in ("true", "false"):
            return ("term", "literal", v.lower(), "", XSD + "boolean")
        if kind == "number":
            return ("term", "literal", v, "", XSD + ("decimal" if "." in v else "integer"))
        if kind == "string":
            body = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), v[1:-1])
            if self.now[0] == "lang":
                self.i += 1
                return ("term", "literal", body, self.tokens[self.i - 1][1][1:].lower(), "")
            if self.now[0] == "type":
                self.i += 1
                return ("term", "literal", body, "", self.term()[2])
            return ("term", "literal", body, "", "")
        raise SparqlError(f"SPARQL_INVALID: term expected, {v!r} found")

    def query(self) -> Query:
        q = Query()
        while self.word("PREFIX"):
            name = self.now[1]
            self.i += 1
            self.prefix[name.rstrip(":")] = self.now[1][1:-1]
            self.i += 1
        if self.word("ASK"):
            q.form = "ASK"
        elif self.word("SELECT"):
            q.distinct = self.word("DISTINCT")
            if not self.mark("*"):
                while self.now[0] == "var" or self.now[1] == "(":
                    if self.mark("("):
                        e = self.expression()
                        if not self.word("AS"):
                            raise SparqlError("SPARQL_INVALID: AS expected")
                        q.select.append((self.var(), e))
                        self.need(")")
                    else:
                        q.select.append((self.var(), None))
        else:
            raise SparqlError("SPARQL_INVALID: SELECT or ASK expected")
        self.word("WHERE")
        q.where = self.group()
        if self.word("GROUP"):
            self.word("BY")
            while self.now[0] == "var":
                q.group_by.append(self.var())
        while self.word("HAVING"):
            q.having.append(self.primary())
        if self.word("ORDER"):
            self.word("BY")
            while True:
                if self.peek("ASC", "DESC"):
                    down = self.now[1].upper() == "DESC"
                    self.i += 1
                    q.order.append((self.primary(), down))
                elif self.now[0] in ("var", "word") and not self.peek("LIMIT", "OFFSET") or self.now[1] == "(":
                    q.order.append((self.primary(), False))
                else:
                    break
        while self.peek("LIMIT", "OFFSET"):
            which = self.now[1].upper()
            n = int(self.tokens[self.i + 1][1])
            self.i += 2
            q.limit, q.offset = (n, q.offset) if which == "LIMIT" else (q.limit, n)
        if self.now[0] != "end":
            raise SparqlError(f"SPARQL_INVALID: {self.now[1]!r} after the query")
        return q

    def group(self) -> Group:
        self.need("{")
        g = Group()
        while not self.mark("}"):
            if self.word("FILTER"):
                g.parts.append(("filter", self.primary()))
            elif self.word("OPTIONAL"):
                g.parts.append(("optional", self.group()))
            elif self.word("GRAPH"):
                g.parts.append(("graph", self.term(), self.group()))
            elif self.word("BIND"):
                self.need("(")
                e = self.expression()
                self.word("AS")
                g.parts.append(("bind", e, self.var()))
                self.need(")")
            elif self.word("VALUES"):
                g.parts.append(self.values())
            elif self.now[1] == "{":
                groups = [self.group()]
                while self.word("UNION"):
                    groups.append(self.group())
                g.parts.append(("union", groups) if len(groups) > 1 else ("group", groups[0]))
            elif not self.mark("."):
                self.triples(g)
        return g

    def triples(self, g: Group) -> None:
        s = self.term()
        while True:
            p = self.term()
            path = next((m for m in "+*" if self.mark(m)), "")
            while True:
                g.parts.append(("triple", s, p, self.term(), path))
                if not self.mark(","):
                    break
            if not self.mark(";"):
                return
            while self.mark(";"):
                pass
            if self.now[1] in (".", "}"):
                return

    def values(self) -> tuple:
        if self.now[0] == "var":
            names = [self.var()]
            self.need("{")
            rows = []
            while not self.mark("}"):
                rows.append([self.term()])
            return ("values", names, rows)
        self.need("(")
        names, rows = [], []
        while not self.mark(")"):
            names.append(self.var())
        self.need("{")
        while not self.mark("}"):
            self.need("(")
            row = []
            while not self.mark(")"):
                row.append(None if self.word("UNDEF") else self.term())
            rows.append(row)
        return ("values", names, rows)

    def expression(self, level: int = 0):
        levels = (("||",), ("&&",), ("=", "!=", "<", ">", "<=", ">="), ("+", "-"), ("*", "/"))
        if level == len(levels):
            return self.primary()
        left = self.expression(level + 1)
        while True:
            if level == 2 and self.peek("IN", "NOT"):
                no = self.word("NOT")
                self.word("IN")
                self.need("(")
                items = [self.expression()]
                while self.mark(","):
                    items.append(self.expression())
                self.need(")")
                left = ("in", left, items) if not no else ("!", ("in", left, items))
                continue
            op = next((m for m in levels[level] if self.mark(m)), None)
            if op is None:
                return left
            left = ("op", op, left, self.expression(level + 1))

    def primary(self):
        if self.mark("("):
            e = self.expression()
            self.need(")")
            return e
        if self.mark("!"):
            return ("!", self.primary())
        if self.now[0] == "word" and self.tokens[self.i + 1] == ("mark", "("):
            name = self.now[1].upper()
            self.i += 2
            if name in AGGREGATES:
                distinct = self.word("DISTINCT")
                e = None if self.mark("*") else self.expression()
                self.need(")")
                return ("aggregate", name, distinct, e)
            args = []
            while not self.mark(")"):
                args.append(self.expression())
                self.mark(",")
            return ("call", name, args)
        return self.term()


def parse(text: str, most: int = 100_000) -> Query:
    if len(text) > most:
        raise SparqlError("QUERY_TOO_LARGE")
    return _Parser(text).query()


def _struct(k: Column, v: Column, lang: Column, d: Column) -> Column:
    return F.struct(k.alias("k"), v.alias("v"), lang.alias("l"), d.alias("d"))


def _constant(t: tuple) -> Column:
    return _struct(*[F.lit(x) for x in t[1:]])


@dataclass
class Solutions:
    df: DataFrame
    vars: list[str]
    maybe: set[str]  # may be unbound


class Compiler:
    def __init__(self, quads: DataFrame, default: DataFrame | None = None):
        self.quads = quads
        self.default = union_graph(quads) if default is None else default
        self.spark = quads.sparkSession

    # patterns

    def source(self, graph) -> DataFrame:
        if graph is None:
            return self.default
        return self.quads if graph[0] == "var" else self.quads.filter(F.col("g") == graph[2])

    def triple(self, s, p, o, path: str, graph) -> Solutions:
        rows = self.source(graph)
        ends = {"s": s, "p": p, "o": o} | ({"g": graph} if graph and graph[0] == "var" else {})
        kinds = {"s": _struct(F.col("s_kind"), F.col("s"), F.lit(""), F.lit("")), "p": _struct(F.lit("iri"), F.col("p"), F.lit(""), F.lit("")), "o": _struct(F.col("o_kind"), F.col("o"), F.col("o_lang"), F.col("o_dt"))}
        if "g" in ends:
            kinds["g"] = _struct(F.lit("iri"), F.col("g"), F.lit(""), F.lit(""))
        if p[0] == "term":
            rows = rows.filter(F.col("p") == p[2])
        if path:
            steps = rows.select(kinds["s"].alias("a"), kinds["o"].alias("b"))
            if o[0] == "term":
                pairs = leading_to(steps, _constant(o))
            elif s[0] == "term":
                pairs = leading_to(steps.select(F.col("b").alias("a"), F.col("a").alias("b")), _constant(s)).select(F.col("b").alias("a"), F.col("a").alias("b"))
            else:
                pairs = transitive(steps)
            if path == "*":
                every = self.source(graph)
                same = every.select(kinds["s"].alias("a")).unionByName(every.select(kinds["o"].alias("a"))).select("a", F.col("a").alias("b"))
                pairs = pairs.unionByName(same).distinct()
            rows, kinds, ends = pairs, {"s": F.col("a"), "o": F.col("b")}, {"s": s, "o": o}
            for e, c in kinds.items():
                if ends[e][0] == "term":
                    rows = rows.filter(c == _constant(ends[e]))
        else:
            if s[0] == "term":
                rows = rows.filter(F.col("s") == s[2])
            if o[0] == "term":
                rows = rows.filter((F.col("o") == o[2]) & (F.col("o_kind") == o[1]) & (F.lower("o_lang") == o[3]) & (F.col("o_dt") == o[4]))
        names: dict[str, Column] = {}
        for e, t in ends.items():
            if t[0] == "var":
                if t[1] in names:
                    rows = rows.filter(names[t[1]] == kinds[e])
                else:
                    names[t[1]] = kinds[e]
        return Solutions(rows.select(*[c.alias(n) for n, c in names.items()]), list(names), set())

    def join(self, a: Solutions, b: Solutions, how: str = "inner", conditions: list = ()) -> Solutions:
        shared = [v for v in a.vars if v in b.vars]
        right = b.df.select(*[F.col(v).alias(f"_r_{v}") for v in b.vars])
        on = []
        for v in shared:
            if v in a.maybe or v in b.maybe:
                on.append(F.col(v).isNull() | F.col(f"_r_{v}").isNull() | (F.col(v) == F.col(f"_r_{v}")))
            else:
                on.append(F.col(v) == F.col(f"_r_{v}"))
        for e in conditions:
            on.append(F.coalesce(self.boolean(e, {v: F.col(v) if v in a.vars else F.col(f"_r_{v}") for v in (*a.vars, *b.vars)}), F.lit(False)))
        whole = reduce(lambda x, y: x & y, on) if on else F.lit(True)
        df = a.df.join(right, whole, how)
        names = [*a.vars, *[v for v in b.vars if v not in a.vars]]
        cols = [F.coalesce(F.col(v), F.col(f"_r_{v}")).alias(v) if v in shared and (v in a.maybe or v in b.maybe) else F.col(v) if v in a.vars else F.col(f"_r_{v}").alias(v) for v in names]
        if how == "left":
            maybe = a.maybe | {v for v in b.vars if v not in a.vars}
        else:
            maybe = {v for v in names if (v not in a.vars or v in a.maybe) and (v not in b.vars or v in b.maybe)}
        return Solutions(df.select(*cols), names, maybe)

    def group(self, g: Group, graph=None) -> Solutions:
        """Triples between other parts are ordered by their constants; filters hold for the whole group."""
        out: Solutions | None = None
        patterns: list[tuple] = []
        filters = [p[1] for p in g.parts if p[0] == "filter"]

        def add(x: Solutions) -> None:
            nonlocal out
            out = x if out is None else self.join(out, x)

        def flush() -> None:
            left = list(patterns)
            patterns.clear()
            while left:
                bound = set(out.vars) if out else set()

                def rank(t: tuple) -> tuple:
                    names = {x[1] for x in t[1:4] if x[0] == "var"}
                    return (bool(bound) and not names & bound, bool(t[4]), -sum(x[0] == "term" for x in (t[1], t[3])), t[2][0] == "var", t[2][-3:] == (RDF + "type", "", ""))

                best = min(left, key=rank)
                left.remove(best)
                add(self.triple(*best[1:5], graph))

        for part in g.parts:
            kind = part[0]
            if kind == "triple":
                patterns.append(part)
                continue
            if kind == "filter":
                continue
            flush()
            if kind == "optional":
                inner = Group([p for p in part[1].parts if p[0] != "filter"])
                conditions = [p[1] for p in part[1].parts if p[0] == "filter"]
                out = self.join(out or self.unit(), self.group(inner, graph), "left", conditions)
            elif kind == "union":
                add(reduce(self.union, (self.group(x, graph) for x in part[1])))
            elif kind == "group":
                add(self.group(part[1], graph))
            elif kind == "graph":
                add(self.group(part[2], part[1]))
            elif kind == "values":
                add(self.inline(part[1], part[2]))
            elif kind == "bind":
                out = out or self.unit()
                out = Solutions(out.df.withColumn(part[2], self.as_term(part[1], self.env(out))), [*out.vars, part[2]], out.maybe | {part[2]})
        flush()
        out = out or self.unit()
        for e in filters:
            out = Solutions(out.df.filter(self.boolean(e, self.env(out))), out.vars, out.maybe)
        return out

    def unit(self) -> Solutions:
        return Solutions(self.spark.range(1).select(), [], set())

    def union(self, a: Solutions, b: Solutions) -> Solutions:
        names = [*a.vars, *[v for v in b.vars if v not in a.vars]]
        return Solutions(a.df.unionByName(b.df, allowMissingColumns=True).select(*names), names, a.maybe | b.maybe | set(a.vars) ^ set(b.vars))

    def inline(self, names: list[str], rows: list[list]) -> Solutions:
        kind = ", ".join(f"`{n}` struct<k:string,v:string,l:string,d:string>" for n in names)
        df = self.spark.createDataFrame([tuple(None if t is None else tuple(t[1:]) for t in r) for r in rows], kind)
        return Solutions(df, names, {n for i, n in enumerate(names) if any(r[i] is None for r in rows)})

    # expressions

    @staticmethod
    def env(s: Solutions) -> dict[str, Column]:
        return {v: F.col(v) for v in s.vars}

    def value(self, e, env: dict[str, Column]) -> tuple[str, Column]:
        """('term' | 'bool' | 'str' | 'num', column)."""
        kind = e[0]
        if kind == "var":
            return ("term", env.get(e[1], F.lit(None).cast("struct<k:string,v:string,l:string,d:string>")))
        if kind == "term":
            if e[4] in (XSD + "integer", XSD + "decimal"):
                return ("num", F.lit(float(e[2])))
            return ("term", _constant(e))
        if kind == "!":
            return ("bool", ~self.boolean(e[1], env))
        if kind == "in":
            return ("bool", reduce(lambda x, y: x | y, (self.compare("=", e[1], x, env) for x in e[2])))
        if kind == "op":
            op = e[1]
            if op == "&&":
                return ("bool", self.boolean(e[2], env) & self.boolean(e[3], env))
            if op == "||":
                return ("bool", self.boolean(e[2], env) | self.boolean(e[3], env))
            if op in "+-*/":
                a, b = self.number(e[2], env), self.number(e[3], env)
                return ("num", {"+": a + b, "-": a - b, "*": a * b, "/": F.try_divide(a, b)}[op])
            return ("bool", self.compare(op, e[2], e[3], env))
        if kind == "call":
            return self.call(e[1], e[2], env)
        if kind == "column":
            return ("num", F.col(e[1]))
        raise SparqlError(f"SPARQL_INVALID: {kind} stands where it can't")

    def call(self, name: str, args: list, env: dict[str, Column]) -> tuple[str, Column]:
        s = lambda i: self.string(args[i], env)
        if name == "STR":
            return ("str", s(0))
        if name in ("LANG", "DATATYPE"):
            return ("str", self.value(args[0], env)[1]["l" if name == "LANG" else "d"])
        if name in ("LCASE", "UCASE"):
            return ("str", F.lower(s(0)) if name == "LCASE" else F.upper(s(0)))
        if name in ("STRSTARTS", "STRENDS", "CONTAINS"):
            return ("bool", {"STRSTARTS": F.startswith, "STRENDS": F.endswith, "CONTAINS": F.contains}[name](s(0), s(1)))
        if name == "REGEX":
            flags = f"(?{args[2][2]})" if len(args) > 2 else ""
            return ("bool", s(0).rlike(flags + args[1][2]))
        if name == "STRLEN":
            return ("num", F.length(s(0)).cast("double"))
        if name == "BOUND":
            return ("bool", self.value(args[0], env)[1].isNotNull())
        if name in ("ISIRI", "ISURI", "ISLITERAL", "ISBLANK"):
            return ("bool", self.value(args[0], env)[1]["k"] == {"ISLITERAL": "literal", "ISBLANK": "bnode"}.get(name, "iri"))
        if name == "COALESCE":
            return ("term", F.coalesce(*[self.as_term(a, env) for a in args]))
        if name == "IF":
            return ("term", F.when(self.boolean(args[0], env), self.as_term(args[1], env)).otherwise(self.as_term(args[2], env)))
        raise SparqlError(f"SPARQL_INVALID: no function {name}")

    def string(self, e, env) -> Column:
        kind, c = self.value(e, env)
        return c["v"] if kind == "term" else c.cast("string")

    def number(self, e, env) -> Column:
        kind, c = self.value(e, env)
        return c["v"].try_cast("double") if kind == "term" else c.cast("double")

    def boolean(self, e, env) -> Column:
        kind, c = self.value(e, env)
        if kind == "bool":
            return c
        if kind == "term":
            return F.when(c["d"] == XSD + "boolean", c["v"] == "true").otherwise(c["v"] != "")
        return c != (0 if kind == "num" else "")

    def as_term(self, e, env) -> Column:
        kind, c = self.value(e, env)
        if kind == "term":
            return c
        dt = {"bool": XSD + "boolean", "str": "", "num": XSD + "decimal"}[kind]
        return F.when(c.isNotNull(), _struct(F.lit("literal"), c.cast("string"), F.lit(""), F.lit(dt)))

    def compare(self, op: str, a, b, env) -> Column:
        (ka, ca), (kb, cb) = self.value(a, env), self.value(b, env)
        if op in ("=", "!="):
            if "num" in (ka, kb):
                same = self.number(a, env) == self.number(b, env)
            elif "bool" in (ka, kb):
                same = self.boolean(a, env) == self.boolean(b, env)
            elif "str" in (ka, kb):
                same = self.string(a, env) == self.string(b, env)
            else:
                same = (ca["k"] == cb["k"]) & (ca["v"] == cb["v"]) & (F.lower(ca["l"]) == F.lower(cb["l"])) & (ca["d"] == cb["d"])
            return same if op == "=" else ~same
        x, y, sx, sy = self.number(a, env), self.number(b, env), self.string(a, env), self.string(b, env)
        test = {"<": lambda p, q: p < q, "<=": lambda p, q: p <= q, ">": lambda p, q: p > q, ">=": lambda p, q: p >= q}[op]
        return F.when(x.isNotNull() & y.isNotNull(), test(x, y)).otherwise(test(sx, sy))

    # query forms

    def run(self, q: Query, terms: bool = False) -> DataFrame:
        s = self.group(q.where)
        if q.form == "ASK":
            return s.df.limit(1).agg((F.count("*") > 0).alias("answer"))
        aggregates: list[Column] = []
        named: dict[str, str] = {}

        def lifted(e):
            """The expression with each aggregate call replaced by a column."""
            if not isinstance(e, tuple):
                return [lifted(x) for x in e] if isinstance(e, list) else e
            if e[0] == "aggregate":
                key = f"_agg_{repr(e)}"
                if key not in named:
                    named[key] = f"_agg{len(named)}"
                    aggregates.append(self.aggregate(e, self.env(s)).alias(named[key]))
                return ("column", named[key])
            return tuple(lifted(x) for x in e)

        select = [(n, None if e is None else lifted(e)) for n, e in q.select] or [(v, None) for v in s.vars]
        having, order = [lifted(e) for e in q.having], [(lifted(e), down) for e, down in q.order]
        df = s.df
        if q.group_by or aggregates:
            df = df.groupBy(*q.group_by).agg(*aggregates) if aggregates else df.select(*q.group_by).distinct()
        env = {c: F.col(c) for c in df.columns if not c.startswith("_agg")}
        for e in having:
            df = df.filter(self.boolean(e, env))
        for n, e in select:
            if e is None:
                if n not in df.columns:
                    df = df.withColumn(n, F.lit(None).cast("struct<k:string,v:string,l:string,d:string>"))
            elif e[0] == "column":
                df = df.withColumn(n, F.col(e[1]))
            else:
                df = df.withColumn(n, self.as_term(e, env))
            env[n] = F.col(n)
        names = [n for n, _ in select]
        if q.distinct:
            df = df.select(*names).distinct()
        if order:
            keys = []
            for e, down in order:
                plain = e[0] == "var" and e[1] in df.columns and not str(df.schema[e[1]].dataType.typeName()) == "struct"
                cols = [F.col(e[1])] if plain else self.order_key(e, {k: c for k, c in env.items() if k in df.columns})
                keys += [c.desc_nulls_last() if down else c.asc_nulls_first() for c in cols]
            df = df.orderBy(*keys)
        if q.offset:
            df = df.offset(q.offset)
        if q.limit is not None:
            df = df.limit(q.limit)
        out = [F.col(n)["v"].alias(n) if not terms and df.schema[n].dataType.typeName() == "struct" else F.col(n) for n in names]
        return df.select(*out)

    def aggregate(self, e, env) -> Column:
        _, name, distinct, arg = e
        if name == "COUNT":
            if arg is None:
                return F.count("*")
            c = self.value(arg, env)[1]
            return F.count_distinct(c) if distinct else F.count(c)
        if name in ("SUM", "AVG"):
            c = self.number(arg, env)
            return {"SUM": F.sum_distinct if distinct else F.sum, "AVG": F.avg}[name](c)
        c = self.string(arg, env)
        number = self.number(arg, env)
        if name == "SAMPLE":
            return F.min(c)
        return (F.min_by if name == "MIN" else F.max_by)(c, F.struct(number, c))

    def order_key(self, e, env) -> list[Column]:
        kind, c = self.value(e, env)
        if kind != "term":
            return [c]
        rank = F.when(c["k"] == "bnode", 1).when(c["k"] == "iri", 2).when(c["k"] == "literal", 3)
        numeric = F.when(c["d"].startswith(XSD) & (c["d"] != XSD + "string"), c["v"].try_cast("double"))
        return [rank, numeric, c["v"], c["l"]]


def run(text: str, quads: DataFrame, default: DataFrame | None = None, terms: bool = False) -> DataFrame:
    """Solutions of a query as a DataFrame of values, or of term structs."""
    return Compiler(quads, default).run(parse(text), terms)
