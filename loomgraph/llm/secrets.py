"""Operator 3: secret scans with a random forest that removes false positives, in DataFrame functions only.

A pattern finds candidates: runs of 12 or more key characters with a digit, runs after a known prefix, and values of 8 or more characters of any
kind but white space that are quoted or assigned beside a secret word. Each gets features: length, character transitions and classes, dictionary
coverage, path, code, and the words beside it. A random forest trained from labelled findings decides. Training runs on the driver over a
bounded table of findings whose features the same DataFrame expressions compute; the forest is compiled to CASE expressions, so that a scan is one
projection: no shuffle, no Python on the executors. Only candidates and what stands between them are held, one document at a time.

Not candidates: shorter values, values with white space in them (each of their words is looked at alone), and runs without a digit that have
neither a known prefix nor a secret word beside them.

Null and empty texts have no candidates; null or repeated ids keep their rows; a very long text is one row; other columns are kept or left out as
asked, never read; an empty table gives an empty table. Equal candidates in one text are separate findings.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "[A-Za-z0-9_+/~-]"
#: Words beside or inside findings.
SECRET_WORDS = "passw|passwd|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer|client.?key"
PUBLIC_WORDS = "sha1|sha256|md5|commit|checksum|digest|uuid|guid|hash|revision|build|isbn|phone|card|order|invoice|example|sample|dummy|version"
DICTIONARY = "the|and|for|key|token|test|example|sample|user|name|data|file|path|image|version|config|class|value|page|item|node|index|part|model|train|layer|result|http|www|com|org|html|report|your|here|this|that|with"
_PREFIX = "AKIA|ASIA|AGPA|AIza|gh[pousr]_|xox[abprs]-|sk_live_|rk_live_|glpat-|eyJ"
KNOWN_PREFIX = f"^({_PREFIX})"
_RUN = f"(?<!{_KEY})(?=[A-Za-z_+/~-]*[0-9]){_KEY}{{12,}}+"
_PREFIXED = f"(?<!{_KEY})(?:{_PREFIX}){_KEY}{{8,}}+"
# what stands before a value: the narrow look first, the one for a secret word only where that holds
_ASSIGNED = f"(?<=[=:>]\\s{{0,4}}[\"']?)(?<=(?i:{SECRET_WORDS})[\\w.: \\])-]{{0,20}}[\"']?\\s{{0,4}}(?:=>|:=|={{1,3}}|:)\\s{{0,4}}[\"']?)"
_QUOTED = f"(?<=[\"'])(?<=(?i:{SECRET_WORDS})[\\w.: -]{{0,20}}[ (,\\[]\\s{{0,4}}[\"'])"
_BEARER = "(?<=\\b(?i:bearer)\\s{1,3})"
_VALUE = "(?:(?<=\")[^\\s\"]{8,}+(?=\")|(?<=')[^\\s']{8,}+(?=')|(?![\"'])[^\\s\"']{7,}[^\\s\"'.,;:(){}<>\\[\\]])"
CANDIDATE = f"(?:{_ASSIGNED}|{_QUOTED}|{_BEARER}){_VALUE}|{_PREFIXED}|{_RUN}"
FEATURES = ("size", "transitions", "digits", "upper", "distinct", "hexadecimal", "dictionary", "slashes", "dashes", "in_path", "secret_beside", "public_beside", "assigned", "quoted", "prefix", "others", "code")


def features(c: Column, left: Column, right: Column) -> list[Column]:
    """FEATURES of a candidate and the texts before and after it, as doubles."""
    n = F.length(c).cast("double")
    near = F.lower(F.right(left, F.lit(40)))
    after = F.lower(F.left(right, F.lit(24)))
    count = lambda x, p: F.regexp_count(x, F.lit(p)).cast("double")
    flag = lambda x: x.cast("double")
    return [
        F.least(n, F.lit(200.0)),
        count(c, "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])") / n,
        count(c, "[0-9]") / n,
        count(c, "[A-Z]") / n,
        F.size(F.array_distinct(F.split(F.left(c, F.lit(200)), ""))).cast("double") / F.least(n, F.lit(32.0)),
        flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        (n - F.length(F.regexp_replace(F.lower(c), DICTIONARY, ""))) / n,
        count(c, "/") / n,
        count(c, "[-_]") / n,
        flag(near.rlike("(://\\S*|[/\\\\.])$") | after.rlike("^(\\.[a-z]{2,4}\\b|/)")),
        flag(near.rlike(SECRET_WORDS)),
        flag(near.rlike(PUBLIC_WORDS) | after.rlike(PUBLIC_WORDS)),
        flag(near.rlike("[=:]\\s*[\"']?$")),
        flag(near.rlike("[\"']$") & after.rlike("^[\"']")),
        flag(c.rlike(KNOWN_PREFIX)),
        count(c, "[^A-Za-z0-9]") / n,
        flag(c.rlike("[A-Za-z_][(\\[]|^[A-Za-z_]+([.:]+[A-Za-z_]+)+$|^[$<{%*(\\[]+|://|^[*.xX]+$")),
    ]


def labelled_findings(n: int = 3000, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(before, candidate, after, label): findings of made-up texts whose kind, and so whose label, is known. A caller's own findings may replace them."""
    r = random.Random(seed)
    low, up, dig, hexa = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    of = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    word = lambda: r.choice(DICTIONARY.split("|")) if r.random() < 0.3 else of(low, r.randint(2, 9))
    prose = lambda: " ".join(word() for _ in range(r.randint(3, 8))) + " "
    name = lambda: r.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "client_key", "auth_token", "DB_PASSWORD", "private_key"])
    assign = lambda: r.choice(["=", " = ", ": ", ":"])
    out = []
    while len(out) < n:
        q = r.choice(['"', "'", ""])
        mixed = low + up + dig
        kind = len(out) % 23
        before, cand, after, label = prose(), "", " " + prose(), 0
        if kind == 0:
            cand, label = r.choice(["AKIA", "ASIA"]) + of(up + "234567", 16), 1
        elif kind == 1:
            before, cand, after, label = before + name() + assign() + q, of(hexa, r.choice([16, 18, 20, 24, 32, 40, 64])), q + after, 1
        elif kind == 2:
            before, cand, after, label = before + name() + assign() + q, of(mixed, r.randint(14, 48)), q + after, 1
        elif kind == 3:
            cand, label = r.choice(["ghp_", "gho_", "glpat-", "sk_live_", "xoxb-"]) + of(mixed, r.randint(24, 40)), 1
        elif kind == 4:
            before, cand, label = before + r.choice(["Bearer ", "Authorization: "]), of(mixed + "-_", r.randint(24, 80)), 1
        elif kind == 5:
            cand, label = "AIza" + of(mixed + "-_", 35), 1
        elif kind == 6:
            before, cand = before + r.choice(["commit ", "sha1 ", "checksum: ", "md5: ", "digest ", "revision "]), of(hexa, r.choice([32, 40, 64]))
        elif kind == 7:
            before, cand = before + r.choice(["uuid ", "", "id "]), "-".join(of(hexa, k) for k in (8, 4, 4, 4, 12))
        elif kind == 8:
            cand = "/".join(word() for _ in range(r.randint(3, 6))) + "/" + word() + of(dig, r.randint(1, 4))
        elif kind == 9:
            before, cand, after = before + "https://www." + word() + ".com/", word() + "-" + word() + "-" + of(dig, 4) + "-" + word(), ".html" + after
        elif kind == 10:
            cand = of(dig, r.randint(12, 19))
        elif kind == 11:
            cand = "_".join(word() for _ in range(r.randint(2, 4))) + "_" + of(dig, r.randint(1, 3)) + word()
        elif kind == 12:
            before, cand, after = before + name() + assign() + q, r.choice(["your_", "example-", "test_", "sample_"]) + word() + "_" + word() + "_" + of(dig, r.randint(1, 3)), q + after
        elif kind == 13:
            cand = of(low, r.randint(4, 12)) + of(dig, r.randint(1, 4)) + of(low, r.randint(6, 12))
        elif kind == 14:  # words without a digit
            q = r.choice("\"'")
            before, cand, after, label = before + name() + assign() + q, "".join(of(low, r.randint(4, 8)) for _ in range(r.randint(2, 4))), q + after, 1
        elif kind == 15:  # other symbols, the last character a letter or digit
            before, cand, after, label = before + name() + assign() + q, of(mixed + "!@#$%^&*?+-_~.,;|", r.randint(9, 24)) + of(mixed, 1), q + after, 1
        elif kind == 16:  # short ones
            before, cand, after, label = before + name() + assign() + q, of(low, r.randint(4, 8)) + of(dig, r.randint(1, 4)) + of(mixed, r.randint(3, 4)), q + after, 1
        elif kind == 17:
            before, cand, after, label = before + r.choice(["the password is ", "my secret ", "set_password(", "token "]) + (q or '"'), of(mixed + r.choice(["", "!@#$%&*"]), r.randint(8, 20)), (q or '"') + after, 1
        elif kind == 18:  # no digit at all
            q = r.choice("\"'")
            before, cand, after, label = before + name() + assign() + q, of(low + up, r.randint(8, 30)), q + after, 1
        elif kind == 19:  # prose after a colon
            before, cand = before + name() + ": ", r.choice([of(low, r.randint(8, 13)), of(up, 1) + of(low, r.randint(7, 12))])
        elif kind == 20:  # code
            before, cand = before + name() + r.choice([" = ", "=", ": "]), r.choice([f"get_{word()}_{word()}(", f"{word()}.{word()}.{name()}", f"os.environ[{word()}", f"self.{word()}_{word()}", f"{word()}::{word()}::{word()}"])
        elif kind == 21:  # places to be filled
            before, cand, after = before + name() + assign() + q, r.choice(["${" + name().upper() + "_" + word() + "}", f"<{word()}-{name()}>", "*" * r.randint(8, 16), "x" * r.randint(8, 16), "{{" + word() + "." + name() + "}}", f"%({name()})s_{word()}"]), q + after
        else:
            before, cand = before + name() + ": ", "https://www." + word() + ".com/" + word() + "/" + word()
        out.append((before, cand, after, label))
    return out


Tree = float | tuple[int, float, "Tree", "Tree"]


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int = 8) -> Tree:
    """A tree on features drawn anew at each node: the split of least Gini impurity; leaves hold the share of secrets."""
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return round(share, 4)
    best = None
    for f in rng.choice(x.shape[1], max(1, round(math.sqrt(x.shape[1]))), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        ones = np.cumsum(t)
        at = np.flatnonzero(v[1:] > v[:-1])
        at = at[(at + 1 >= least) & (len(y) - at - 1 >= least)]
        if not len(at):
            continue
        n1 = at + 1
        p1, p2 = ones[at] / n1, (ones[-1] - ones[at]) / (len(y) - n1)
        cost = n1 * p1 * (1 - p1) + (len(y) - n1) * p2 * (1 - p2)
        i = int(np.argmin(cost))
        if best is None or cost[i] < best[0]:
            best = (cost[i], int(f), float((v[at[i]] + v[at[i] + 1]) / 2))
    if best is None:
        return round(share, 4)
    _, f, cut = best
    low = x[:, f] <= cut
    return f, cut, grow(x[low], y[low], rng, depth - 1, least), grow(x[~low], y[~low], rng, depth - 1, least)


def forest(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 6, seed: int = 5) -> list[Tree]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        some = rng.integers(0, len(y), len(y))
        out.append(grow(x[some], y[some], rng, depth))
    return out


def vote(trees: list[Tree], x: list[Column]) -> Column:
    """Mean of the trees' leaves as an expression."""

    def of(t: Tree) -> Column:
        return F.lit(t) if isinstance(t, float) else F.when(x[t[0]] <= t[1], of(t[2])).otherwise(of(t[3]))

    total = of(trees[0])
    for t in trees[1:]:
        total = total + of(t)
    return total / len(trees)


def train(spark: SparkSession, findings: list[tuple[str, str, str, int]] | None = None, most: int = 20_000) -> list[Tree]:
    """A forest from labelled findings, of which at most `most` are used."""
    rows = (findings or labelled_findings())[:most]
    table = spark.createDataFrame(rows, "before string, candidate string, after string, label int").coalesce(1)
    got = table.select(F.array(*features(F.col("candidate"), F.col("before"), F.col("after"))).alias("x"), "label").collect()
    return forest(np.array([r["x"] for r in got]), np.array([r["label"] for r in got]))


def scan(docs: DataFrame, trees: list[Tree], threshold: float = 0.5, mask: str = "<SECRET>", id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs: doc_id, n_candidates, n_secrets, findings (candidate, score, secret), clean_text; keep: columns of docs that come along in a column `kept`, a struct of theirs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("_id"), *[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)], text.alias("_text"))
    found = found.withColumn("_c", F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0))).withColumn("_gap", F.when(F.size("_c") > 0, F.split("_text", CANDIDATE, -1)))
    # features first, votes on their array after: each feature is computed once
    with_x = F.transform("_c", lambda c, i: F.struct(c.alias("candidate"), F.array(*features(c, F.element_at("_gap", i + 1), F.element_at("_gap", i + 2))).alias("x")))
    found = found.withColumn("_x", with_x)
    score = F.transform("_x", lambda s: F.struct(s["candidate"].alias("candidate"), vote(trees, [s["x"][i] for i in range(len(FEATURES))]).alias("score")))
    found = found.withColumn("_s", score)
    found = found.withColumn("findings", F.transform("_s", lambda s: F.struct(s["candidate"].alias("candidate"), F.round(s["score"], 4).alias("score"), (s["score"] >= threshold).alias("secret"))))
    shown = F.transform("findings", lambda f, i: F.concat(F.when(f["secret"], F.lit(mask)).otherwise(f["candidate"]), F.element_at("_gap", i + 2)))
    clean = F.when(F.size("_c") > 0, F.concat(F.element_at("_gap", 1), F.array_join(shown, ""))).otherwise(F.col("_text"))
    return found.select(
        F.col("_id").alias(id_col), F.size("_c").cast("long").alias("n_candidates"), F.size(F.filter("findings", lambda f: f["secret"])).cast("long").alias("n_secrets"), "findings", clean.alias("clean_text"),
        *([F.struct(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]).alias("kept")] if keep else []),
    )
