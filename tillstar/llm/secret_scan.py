"""Secret scans through an inverted index of trigrams.

Each rule's regular expression is turned into a Boolean query: an OR of ANDs of
the lower-case trigrams that any match must contain. The postings (trigram,
doc_id) of the trigrams that some rule names are intersected per query, which
leaves a small table of candidates. Only candidates are verified with the regular
expression; a rule without mandatory trigrams is run on every text. All of it is
DataFrame expressions; a match's place comes from the lengths of the pieces
between matches.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import stored

#: Alternatives of a query; a rule with more is cut into shorter literals.
MOST_PATHS = 64
_BREAK = "\n\n"  # separates the literals of a path; no trigram spans it


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of the whole match or of group 2."""

    kind: str
    pattern: str
    least: int
    group: int = 0


#: The base rules of the contract, in its order, then the added ones.
BASE_RULES = (
    Rule("assign",
         r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
         r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
         r"""([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # Runs of hex digits are maximal, so the least length may stand in the pattern.
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
ADDED_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 39),
    Rule("stripe", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 20),
    # A longer scheme is found too, from its last ten letters on.
    Rule("url_login", r"[a-z]{2,10}://[^\s:/@]+:[^\s:/@]+@", 8),
)
RULES = BASE_RULES + ADDED_RULES


def _paths(nodes) -> list[str]:
    """Texts that a match must contain, as alternatives; _BREAK stands for what is not fixed."""
    found = [""]
    for op, value in nodes:
        if op is sre.LITERAL:
            parts = [chr(value).lower()]
        elif op is sre.IN:
            one = {chr(v).lower() for o, v in value if o is sre.LITERAL}
            fixed = all(o is sre.LITERAL for o, _ in value)
            parts = sorted(one) if fixed and len(one) <= 5 else [_BREAK]
        elif op is sre.BRANCH:
            parts = [p for branch in value[1] for p in _paths(branch)]
        elif op is sre.SUBPATTERN:
            parts = _paths(value[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = value
            whole = _paths(inner)
            if (low, high) == (0, 1):
                parts = ["", *whole]
            elif low == 0:
                parts = [_BREAK]
            else:
                parts = whole if (low, high) == (1, 1) else [p + _BREAK for p in whole]
        else:
            parts = [_BREAK]
        joined = {a + b for a, b in product(found, parts)}
        found = sorted(joined) if len(joined) <= MOST_PATHS else sorted({a + _BREAK for a in found})
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The OR of ANDs of trigrams a match needs; empty if a match may have none."""
    clauses = set()
    for path in _paths(sre_parser.parse(pattern)):
        grams = {path[i:i + 3] for i in range(len(path) - 2)}
        clauses.add(frozenset(g for g in grams if "\n" not in g))
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(doc_id, gram): the number of every listed trigram that a text holds, in either case."""
    lowered = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array(*[F.when(F.col("low").contains(g), k) for k, g in enumerate(trigrams)])
    return lowered.select("doc_id", F.explode(F.array_compact(held)).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): numbers of the rules whose query some text of that id satisfies."""
    queries = {k: trigram_query(r.pattern) for k, r in enumerate(rules)}
    trigrams = sorted({g for q in queries.values() for clause in q for g in clause})
    number = {g: k for k, g in enumerate(trigrams)}
    clauses = [(rule, clause) for rule, q in queries.items() for clause in q]
    terms = [(c, rule, number[g], place, (1 << len(clause)) - 1)
             for c, (rule, clause) in enumerate(clauses) for place, g in enumerate(sorted(clause))]
    # The rules' own trigrams: a list of the code, not of the data.
    wanted = F.broadcast(docs.sparkSession.createDataFrame(
        terms, "clause int, rule int, gram int, place int, needed int"))
    matched = postings(docs, trigrams).join(wanted, "gram").groupBy(
        "doc_id", "clause", "rule", "needed"
    ).agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("held"))
    return matched.filter("held = needed").groupBy("doc_id").agg(
        F.collect_set("rule").alias("rules"))


def spans(text: Column, rule: Rule) -> Column:
    """Matches of a rule as structs (start, end), in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    both = F.zip_with(
        F.zip_with(whole, judged, lambda w, j: F.struct(
            F.length(w).alias("size"), (F.length(j) >= rule.least).alias("holds"))),
        between, lambda m, gap: F.struct(m["size"].alias("size"), m["holds"].alias("holds"),
                                         gap.alias("gap")))
    empty = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("found"))
    placed = F.aggregate(F.filter(both, lambda m: m["size"].isNotNull()), empty, lambda a, m: F.struct(
        (a["at"] + m["gap"] + m["size"]).alias("at"),
        F.when(m["holds"], F.concat(a["found"], F.array(F.struct(
            (a["at"] + m["gap"]).alias("start"),
            (a["at"] + m["gap"] + m["size"]).alias("end"))))).otherwise(a["found"]).alias("found")))
    return placed["found"]


def _numbered(found: Column, kind: int) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind_no"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, text, found): for every row its spans (start, kind_no, end), sorted.

    NULL and empty texts have none. Candidates are kept by doc_id; NULL ids and
    rows that share an id are verified each on its own text.
    """
    listed = stored(candidates(docs, rules), "candidates").withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = texts.join(listed, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    parts = []
    for k, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            wanted = F.coalesce(F.array_contains("rules", k), F.lit(False))
        else:
            wanted = F.col("text").rlike(rule.pattern)
        found = F.when(wanted, spans(F.col("text"), rule)).otherwise(none)
        parts.append(_numbered(found, k))
    return marked.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("found"))


def as_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind_no"] + 1), s["start"], s["end"])), ",")
