"""Rule tables as an index on their equality tests.

A chained CASE tests rule after rule.  Most rules of a large table begin with
an equality on the same column (the traffic source of the channel table), so
nearly all of those tests are in vain.  The index reads the rules once and
takes the column that most rules fix to literals.  For each literal it lists the
rules that can still match, in their order: those that name the literal, and the
rules without a literal that stand before the last of them.  The list ends at a
rule that nothing but the literal decides.  A row picks its list by its value
and walks that alone; rows that no list settles walk the rules without a literal.

Spark fuses a projection with its neighbours into one method, and the virtual
machine interprets methods of more than 8000 bytes instead of compiling them.  A
lambda function in the projection keeps it apart from its neighbours, and Spark
then splits it into small methods; here the lambda tests whether a row has any
label at all, as rows without one are settled by the null tests of the table.
"""

from __future__ import annotations

import ast
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.rules import Rule, classify

#: Tables of fewer rules are plain CASE expressions.
FEW_RULES = 12
_TEST = re.compile(r"""(?P<column>\w+)\s+(?:
      =\s*(?P<equal>'(?:[^']|'')*')
    | IN\s*\((?P<among>\s*'(?:[^']|'')*'(?:\s*,\s*'(?:[^']|'')*')*\s*)\)
    | (?P<null>IS\s+NULL) | (?:NOT\s+)?LIKE\s+'(?:[^']|'')*' | IS\s+NOT\s+NULL)""", re.VERBOSE | re.IGNORECASE)
_LITERAL = re.compile(r"'((?:[^']|'')*)'")


class Test:
    """One test of one column; ``values`` are the literals that an equality or a list allows."""

    def __init__(self, found: re.Match):
        self.column = found["column"]
        listed = found["equal"] or found["among"]
        self.values = frozenset(v.replace("''", "'") for v in _LITERAL.findall(listed)) if listed else None
        self.is_null = found["null"] is not None


def terms_of(predicate: str) -> list[list[Test]]:
    """The predicate as alternatives of AND-ed tests.

    Read are tests of one column against literals (=, IN, LIKE, NOT LIKE, null tests) under AND, OR and brackets.
    """
    tests: list[Test] = []

    def named(found: re.Match) -> str:
        tests.append(Test(found))
        return f"t{len(tests) - 1}"

    def alternatives(node: ast.expr) -> list[list[Test]]:
        if isinstance(node, ast.Name) and re.fullmatch(r"t\d+", node.id):
            return [[tests[int(node.id[1:])]]]
        if isinstance(node, ast.BoolOp):
            parts = [alternatives(v) for v in node.values]
            if isinstance(node.op, ast.Or):
                return [term for part in parts for term in part]
            return [sum(choice, []) for choice in product(*parts)]
        raise ValueError(f"not a rule over literals: {predicate}")

    text = re.sub(r"\b(AND|OR)\b", lambda m: m[0].lower(), _TEST.sub(named, predicate), flags=re.IGNORECASE)
    try:
        return alternatives(ast.parse(text.strip(), mode="eval").body)
    except SyntaxError as wrong:
        raise ValueError(f"not a rule over literals: {predicate}") from wrong


def fixed_to(terms: list[list[Test]], column: str) -> frozenset[str] | None:
    """The values of the column outside which no term holds; None if some term leaves it open."""
    allowed = [[t.values for t in term if t.column == column and t.values is not None] for term in terms]
    if not all(allowed):
        return None
    return frozenset().union(*[frozenset.intersection(*values) for values in allowed])


class RuleIndex:
    """The rules of a table by the literal that they need; see the module's text."""

    def __init__(self, rules: Sequence[Rule], default: str | None):
        self.rules, self.default = list(rules), default
        terms = [terms_of(predicate) for _, predicate in self.rules]
        self.columns = list(dict.fromkeys(t.column for own in terms for term in own for t in term))
        counts = Counter(c for own in terms for c in self.columns if fixed_to(own, c) is not None)
        self.key = counts.most_common(1)[0][0] if counts else None
        fixed = [fixed_to(own, self.key) if self.key else None for own in terms]
        self.open_rules = [rule for rule, values in zip(self.rules, fixed, strict=True) if values is None]
        #: literal: its rules in order, and whether the last of them always holds
        self.lists: dict[str, tuple[list[Rule], bool]] = {}
        for value in sorted({v for values in fixed if values for v in values}):
            own, length, settled = [], 0, False
            for n, rule in enumerate(self.rules):
                if fixed[n] is not None and value not in fixed[n]:
                    continue
                own.append(rule)
                if fixed[n] is not None:
                    length = len(own)
                    settled = any(all(t.column == self.key and t.values and value in t.values for t in term)
                                  for term in terms[n])
                    if settled:
                        break
            self.lists[value] = own[:length], settled
        #: the label of a row whose tested columns are all NULL
        self.unlabelled = next((label for (label, _), own in zip(self.rules, terms, strict=True)
                                if any(all(t.is_null for t in term) for term in own)), default)

    def column(self) -> Column:
        """The label of the first matching rule."""
        out = classify(self.open_rules, self.default)
        if self.lists:
            # NULL: a list that has settled nothing, or a value without a list
            picked = None
            for value, (rules, settled) in self.lists.items():
                here = F.col(self.key) == value
                last = rules[-1][0] if settled else None
                found = classify(rules[:-1] if settled else rules, last)
                picked = F.when(here, found) if picked is None else picked.when(here, found)
            out = F.coalesce(picked, out)
        some = F.exists(F.array(*[F.col(c) for c in self.columns]), lambda value: value.isNotNull())
        return F.when(some, out).otherwise(F.lit(self.unlabelled).cast("string"))


def classify_by_index(df: DataFrame, tables: Mapping[str, tuple[Sequence[Rule], str | None]]) -> DataFrame:
    """Add one column per rule table (first matching rule wins); labels are never NULL, the default may be."""
    return df.withColumns({name: RuleIndex(rules, default).column() if len(rules) >= FEW_RULES
                           else classify(rules, default) for name, (rules, default) in tables.items()})
