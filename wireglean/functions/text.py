"""Headers, labels and display texts."""

import itertools
import re
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import case, lookup, named, text


def snake_case(header: str) -> str:
    """One raw header as a snake_case name; a header without letters or digits is ``unnamed``."""
    words = re.findall(r"[0-9A-Za-z]+", header)
    return "_".join(words).lower() if words else "unnamed"


def snake_headers(headers: list[str]) -> list[str]:
    """All headers in snake_case; the n-th repeat of a name gets the suffix ``_n``, or the next that is free."""
    taken: set[str] = set()
    found = []
    for name in map(snake_case, headers):
        numbered = itertools.chain([name], (f"{name}_{n}" for n in itertools.count(1)))
        found.append(next(n for n in numbered if n not in taken))
        taken.add(found[-1])
    return found


def label_words(column: str) -> Column:
    """Label text reduced to lower-case words of letters and digits."""
    lowered = f"lower(trim(CAST({named(column)} AS STRING)))"
    return F.expr(f"trim(regexp_replace({lowered}, '[^a-z0-9]+', ' '))")


def label_family(words: str) -> Column:
    """The attack family of a label, given the column of its words (see :func:`label_words`).

    An exact key wins, then the first key the text contains, then ``Other``. A missing
    label gives the empty string. The words are a column, because every rule names them.
    """
    exact = lookup({text(key): text(family) for key, family in tax.LABEL_FAMILIES}, words)
    rules = [(f"{words} IS NULL OR {words} IN ('', 'nan')", "''")]
    # Neighbours of one family need one test: whichever of them is contained, the answer is the same.
    for family, group in groupby(tax.LABEL_FAMILIES, key=lambda rule: rule[1]):
        either = "|".join(key for key, _ in group)
        rules.append((f"{words} RLIKE {text(either)}", text(family)))
    return F.expr(f"coalesce({exact}, {case(rules, text(tax.OTHER))})")


def masked_ip(column: str) -> Column:
    """Keep the first two octets of an IPv4 address; other text is unchanged."""
    address = f"CAST({named(column)} AS STRING)"
    octets = f"split({address}, '[.]')"
    return F.expr(f"CASE WHEN size({octets}) = 4 "
                  f"THEN concat({octets}[0], '.', {octets}[1], '.x.x') ELSE {address} END")


PREFIXES = [("port_category_", "Service: "), ("protocol_", "Protocol: ")]


def display_name(feature: str) -> Column:
    """The reader-facing name of the model feature in a column."""
    rules = [(f"{feature} = {text(name)}", text(shown)) for name, shown in tax.DISPLAY_NAMES.items()]
    rules += [(f"startswith({feature}, {text(prefix)})",
               f"concat({text(title)}, substr({feature}, {len(prefix) + 1}))") for prefix, title in PREFIXES]
    return F.expr(case(rules, f"initcap(replace({feature}, '_', ' '))"))


def display_text(feature: str) -> str:
    """The same name for a feature known on the driver, such as a model's column list."""
    if feature in tax.DISPLAY_NAMES:
        return tax.DISPLAY_NAMES[feature]
    for prefix, title in PREFIXES:
        if feature.startswith(prefix):
            return title + feature[len(prefix):]
    return feature.replace("_", " ").title()
