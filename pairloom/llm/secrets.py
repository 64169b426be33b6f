"""Secret scans over a trigram inverted index, in DataFrame operations only.

Every rule is a regular expression. From its syntax tree follow strings of which any match
holds at least one, and so a Boolean query over trigrams: a conjunction of clauses,
each an alternative of trigram sets. The index has a posting (trigram, document) for every
trigram that some rule asks for. A rule's postings are intersected by its query, and only the
documents that are left are verified with the expression; a rule without mandatory
trigrams is run on all.

The base rules come first; ``TOKEN_RULES`` are the published forms of access tokens and
other credentials. A rule without mandatory trigrams among them scans every text.

Null texts are empty, and an empty table has no rows. Documents without an id are in no posting and
are verified for every rule. Rows with equal ids share their postings, which only adds
candidates; each is verified on its own text and stays a row. Spans are in code points, end
exclusive; those that start together are in the order of the rules. Positions are running sums in
blocks, so a text of many matches takes a time of their number to the power 1.5 at most, and
otherwise of its length. Other columns of the table are not read.
"""

import re._parser as sre  # the syntax tree of Python's own expressions
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.bind import let
from pairloom.functions.sums import running_sums
from pairloom.staging import staged

from .common import small


@dataclass(frozen=True)
class Rule:
    """Matches, leftmost and without overlap, whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules. Letters of the first group are in either case.
BASE_RULES = [
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are whole either way; this form skips the short ones at once.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
]

# Public forms of tokens and credentials. Expressions that Java, RE2 and Python read alike.
TOKEN_RULES = [
    Rule("github", r"(?:gho|ghp|ghr|ghs|ghu)_[A-Za-z0-9]{36,}"),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]{60,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", r"https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("stripe", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("google_oauth", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("google_client", r"GOCSPX-[A-Za-z0-9_-]{28}"),
    Rule("temporary_access", r"ASIA[A-Z0-9]{16}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("mailgun", r"key-[0-9a-f]{32}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{50,}"),
    Rule("docker", r"dckr_pat_[A-Za-z0-9_-]{20,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("storage_account", r"AccountKey=[A-Za-z0-9+/=]{40,}"),
    Rule("droplet", r"do[opr]_v1_[0-9a-f]{64}"),
    Rule("shopify", r"shp(?:at|ca|pa|ss)_[0-9A-Fa-f]{32}"),
    Rule("square", r"sq0(?:atp|csp)-[A-Za-z0-9_-]{22,}"),
    Rule("notebook_host", r"dapi[0-9a-f]{32}"),
    Rule("model_hub", r"hf_[A-Za-z0-9]{30,}"),
    Rule("grafana", r"glsa_[A-Za-z0-9]{32}_[0-9A-Fa-f]{8}"),
    Rule("chat_hook", r"https://discord(?:app)?\.com/api/webhooks/[0-9]+/[A-Za-z0-9_-]{20,}"),
    Rule("bot", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("login_in_address", r"[a-z][a-z0-9+.-]+://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+=-]+@[A-Za-z0-9.-]+"),
    Rule("bearer", r"Bearer [A-Za-z0-9._~+/-]{20,}"),
]
RULES = [*BASE_RULES, *TOKEN_RULES]

#: Trigrams of one alternative that the index is asked for: all of them must occur, so some are enough.
MOST_TRIGRAMS = 2

#: Strings that a part of an expression is expanded to at most; beyond it the part is left out.
MOST_STRINGS = 64

#: A clause: alternatives, each a set of trigrams that must all occur.
Clause = frozenset[frozenset[str]]


def _strings(node) -> list[str] | None:
    """All strings of a node of the syntax tree in lower case; None if they are too many."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg).lower()] if arg < 128 else None
    if op is sre.IN:
        found = set()
        for kind, value in arg:
            if kind is sre.LITERAL and value < 128:
                found.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] < 128 and value[1] - value[0] < MOST_STRINGS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return sorted(found) if len(found) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        return None if None in parts else sorted({s for p in parts for s in p})
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and (arg[0], arg[1]) in ((0, 1), (1, 1)):
        inner = _sequence(arg[2])
        return None if inner is None else sorted({*inner, *([""] if arg[0] == 0 else [])})
    return [""] if op is sre.AT else None


def _sequence(nodes) -> list[str] | None:
    found = [""]
    for node in nodes:
        more = _strings(node)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = [a + b for a, b in product(found, more)]
    return found


def _commonness(trigram: str) -> tuple[int, str]:
    """Letters and blanks are common, digits and marks are not."""
    return sum(c.isalpha() or c == " " for c in trigram), trigram


def _clause(strings: list[str]) -> Clause | None:
    """What any of the strings implies; None if one of them has no trigram."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(o < s for o in sets))


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that every text with a match satisfies; none if all texts must be scanned."""
    clauses: list[Clause] = []

    def end(run: list[str]) -> None:
        clause = _clause(run)
        if clause is not None:
            clauses.append(clause)

    def walk(nodes, run: list[str]) -> list[str]:
        for node in nodes:
            more = _strings(node)
            if more is not None and len(run) * len(more) <= MOST_STRINGS:
                run = [a + b for a, b in product(run, more)]
                continue
            op, arg = node
            if op is sre.SUBPATTERN:
                run = walk(arg[-1], run)
                continue
            end(run)
            run = [""]
            if more is not None:
                run = more
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
                end(walk(arg[2], [""]))
        return run

    end(walk(sre.parse(pattern), [""]))
    return clauses


def index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(trigram, doc_id): the postings of the given lower-case trigrams."""
    # Lower case of all letters finds more than that of A-Z alone, never less.
    rows = docs.filter(F.isnotnull(id_col)).select(F.col(id_col).alias("doc_id"), F.lower(text_col).alias("low"))
    held = F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams))
    return rows.select("doc_id", F.explode(F.array_compact(held)).alias("trigram"))


def _holds(clauses: list[Clause]) -> Column:
    """The query over Boolean columns named by trigram number."""
    out = F.lit(True)
    for clause in clauses:
        some = F.lit(False)
        for trigrams in clause:
            every = F.lit(True)
            for t in sorted(trigrams):
                every = every & F.col(_name(t))
            some = some | every
        out = out & some
    return out


def _name(trigram: str) -> str:
    return "t_" + trigram.encode().hex()


def candidates(docs: DataFrame, rules: list[Rule], id_col: str, text_col: str) -> DataFrame | None:
    """doc_id and a flag for each rule with a query; only documents that some rule may match."""
    asked = lambda some: frozenset(sorted(some, key=_commonness)[:MOST_TRIGRAMS])
    queries = {r.kind: [frozenset(map(asked, c)) for c in q] for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for c in q for s in c for t in s})
    if not trigrams:
        return None
    postings = staged(index(docs, trigrams, id_col, text_col).sortWithinPartitions("trigram"), "postings")
    held = postings.groupBy("doc_id").agg(*(F.max(F.col("trigram") == t).alias(_name(t)) for t in trigrams))
    flags = held.select("doc_id", *(_holds(q).alias(f"may_{k}") for k, q in queries.items()))
    some = " OR ".join(f"may_{k}" for k in queries)
    return staged(flags.filter(some), "candidates")


def _spans(rule: Rule, number: int, text: Column) -> Column:
    """Spans of the rule's matches: start, number, end, kind."""
    pattern = F.lit(rule.pattern)
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    matches = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length).alias("size"),
        F.transform(held, lambda h: F.char_length(h) >= rule.least).alias("holds"),
    )

    def placed(all_: Column) -> Column:
        ends = running_sums(F.transform(all_, lambda m: (m["gap"] + F.coalesce(m["size"], F.lit(0))).cast("bigint")))
        spans = F.zip_with(
            all_,
            ends,
            lambda m, end: F.struct(
                (end - m["size"]).alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(rule.kind).alias("kind"), m["holds"].alias("holds")
            ),
        )
        return F.filter(spans, lambda s: F.coalesce(s["holds"], F.lit(False)))  # the last gap has no match behind it

    return let(matches, placed)


_NONE = "cast(array() as array<struct<start: bigint, number: int, end: bigint, kind: string, holds: boolean>>)"


def scan(
    docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and spans (start, end, kind) of every row of ``docs``, by start and then by rule."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = candidates(docs, rules, id_col, text_col)
    if marked is not None:
        rows = rows.join(small(marked, 64), "doc_id", "left")
    found = []
    for number, rule in enumerate(rules):
        asked = F.col("text").rlike(rule.pattern)
        if f"may_{rule.kind}" in rows.columns:
            asked = (F.isnull("doc_id") | F.coalesce(f"may_{rule.kind}", F.lit(False))) & asked
        found.append(F.when(asked, _spans(rule, number, F.col("text"))).otherwise(F.expr(_NONE)))
    spans = F.transform(
        F.array_sort(F.concat(*found)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return rows.select("doc_id", spans.alias("spans"))
