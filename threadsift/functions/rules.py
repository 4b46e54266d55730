"""Static rejection of bulk mail as column expressions.

Every rule is a boolean column over the header array, so a scan needs the headers
only and never leaves the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.headers import address, display_name
from threadsift.functions.scalars import bound, trim_blank

REASONS = ("auth", "sender", "bulk_header", "subject", "sender_name", "free_mail")


@dataclass(frozen=True)
class RuleLists:
    """The word lists behind the rules; the defaults are the fixed values."""

    blocked_prefixes: tuple[str, ...] = fixed.BLOCKED_PREFIXES
    blocked_domain_tokens: tuple[str, ...] = fixed.BLOCKED_DOMAIN_TOKENS
    bulk_headers: tuple[str, ...] = fixed.BULK_HEADERS
    bulk_precedence_values: tuple[str, ...] = fixed.BULK_PRECEDENCE_VALUES
    mailing_tools: tuple[str, ...] = fixed.MAILING_TOOLS
    automated_subject_terms: tuple[str, ...] = fixed.AUTOMATED_SUBJECT_TERMS
    impersonal_names: tuple[str, ...] = fixed.IMPERSONAL_NAMES
    free_mail_patterns: tuple[str, ...] = fixed.FREE_MAIL_PATTERNS


DEFAULT_LISTS = RuleLists()


def _any(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _words(words) -> Column:
    """The words in lower case as one array literal."""
    quoted = ", ".join("'" + word.lower().replace("\\", "\\\\").replace("'", "\\'") + "'" for word in words)
    return F.expr(f"array({quoted})")


def _contains_any(text: Column, words) -> Column:
    """One pattern over a short text: a single pass instead of one search per word."""
    return text.rlike("|".join(re.escape(word.lower()) for word in words)) if words else F.lit(False)


def _starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    # A prefix that ends at its only '@' is a whole local part: one lookup replaces
    # a chain of prefix tests.
    local_parts = [p for p in prefixes if p.find("@") == len(p) - 1]
    others = [p for p in prefixes if p not in local_parts]
    local_part = F.concat(F.substring_index(text, "@", 1), F.lit("@"))
    by_name = (F.array_contains(_words(local_parts), local_part) & text.contains("@")) if local_parts else F.lit(False)
    return _any([by_name, *(text.startswith(p) for p in others)])


def blocked_address(a: Column, lists: RuleLists = DEFAULT_LISTS) -> Column:
    """Like `blocked_sender` for an address that is trimmed and in lower case already."""
    domain = F.when(a.contains("@"), F.substring(a, F.instr(a, "@") + 1, F.length(a))).otherwise("")
    return (
        (a == "")
        | _starts_with_any(a, lists.blocked_prefixes)
        | _contains_any(domain, lists.blocked_domain_tokens)
    )


def blocked_sender(sender_address: Column, lists: RuleLists = DEFAULT_LISTS) -> Column:
    """Empty address, blocked prefix, or a domain with a blocked token."""
    plain = F.lower(trim_blank(F.coalesce(sender_address, F.lit(""))))
    return bound(plain, lambda a: blocked_address(a, lists))


# What the rules look at, in two steps: header values first, then what follows from them.
FACTS = ("auth", "address", "display_name", "subject", "precedence", "names", "values")


def _raw_facts(names: Column, values: Column) -> dict[str, Column]:
    """Header values by lower-case name; the first header of a name counts."""

    def value(name: str) -> Column:
        return F.coalesce(F.get(values, (F.array_position(names, name) - 1).cast("int")), F.lit(""))

    return {
        "auth": value("authentication-results"),
        "sender": value("from"),
        "subject": F.lower(value("subject")),
        "precedence": F.lower(value("precedence")),
        "names": names,
        "values": F.lower(F.array_join(values, "\n")),
    }


def _facts(raw) -> dict[str, Column]:
    derived = {"address": address(raw["sender"]), "display_name": F.lower(display_name(raw["sender"]))}
    return {name: derived[name] if name in derived else raw[name] for name in FACTS}


def _flags(f, lists: RuleLists) -> dict[str, Column]:
    return {
        "auth": (f["auth"] != "") & ~_any(f["auth"].contains(mark) for mark in fixed.AUTH_PASS_MARKS),
        "sender": (f["address"] != "") & blocked_address(f["address"], lists),
        "bulk_header": F.coalesce(F.arrays_overlap(f["names"], _words(lists.bulk_headers)), F.lit(False))
        # Tool names hold no line break, so the joined values match where a single one does.
        | _any(f["values"].contains(tool.lower()) for tool in lists.mailing_tools)
        | _contains_any(f["precedence"], lists.bulk_precedence_values),
        "subject": _contains_any(f["subject"], lists.automated_subject_terms),
        "sender_name": F.array_contains(_words(lists.impersonal_names), f["display_name"]),
        "free_mail": _any(f["address"].rlike("(?i)" + p) for p in lists.free_mail_patterns),
    }


def _first_reason(flags: dict[str, Column]) -> Column:
    return F.coalesce(*(F.when(flags[reason], F.lit(reason)) for reason in REASONS))


def _names_and_values(headers: Column) -> tuple[Column, Column]:
    present = F.coalesce(headers, F.array().cast("array<struct<name:string,value:string>>"))
    return F.transform(present, lambda h: F.lower(h["name"])), present["value"]


def _bound_facts(headers: Column) -> Column:
    names, values = _names_and_values(headers)
    raw = bound(
        F.struct(names.alias("n"), values.alias("v")),
        lambda s: F.struct(*[c.alias(name) for name, c in _raw_facts(s["n"], s["v"]).items()]),
    )
    return bound(raw, lambda r: F.struct(*[c.alias(name) for name, c in _facts(r).items()]))


def rule_flags(headers: Column, lists: RuleLists = DEFAULT_LISTS) -> dict[str, Column]:
    """One boolean column per reason, in the order the reasons are reported."""
    facts = _bound_facts(headers)

    def flag(reason: str) -> Column:
        return bound(facts, lambda f: _flags(f, lists)[reason])

    return {reason: flag(reason) for reason in REASONS}


def reject_reason(headers: Column, lists: RuleLists = DEFAULT_LISTS) -> Column:
    """First rule that rejects the mail, NULL when it passes (for nested headers)."""
    return bound(_bound_facts(headers), lambda f: _first_reason(_flags(f, lists)))


def with_reject_reason(messages: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """Messages with `reason`: the first rule that rejects them, NULL when they pass.

    The facts are columns of their own steps, so each is computed once and the rules
    run as generated code.
    """
    kept = messages.columns
    names, values = _names_and_values(F.col("headers"))
    staged = messages.withColumns({"_n": names, "_v": values})
    raw = _raw_facts(F.col("_n"), F.col("_v"))
    staged = staged.withColumns({f"_{name}": column for name, column in raw.items()})
    facts = _facts({name: F.col(f"_{name}") for name in raw})
    staged = staged.withColumns({f"_{name}": column for name, column in facts.items()})
    reason = _first_reason(_flags({name: F.col(f"_{name}") for name in FACTS}, lists))
    return staged.select(*kept, reason.alias("reason"))


def is_rejected(headers: Column, lists: RuleLists = DEFAULT_LISTS) -> Column:
    return reject_reason(headers, lists).isNotNull()
