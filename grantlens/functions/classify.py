"""Classification of assistance-listing codes and project titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Assistance-listing (CFDA) code -> directorate code.
CFDA_DIRECTORATES = {
    "47.041": "ENG",
    "47.049": "MPS",
    "47.050": "GEO",
    "47.070": "CISE",
    "47.074": "BIO",
    "47.075": "SBE",
    "47.076": "EDU",
    "47.078": "OPP",
    "47.079": "OD",
    "47.083": "OIA",
    "47.084": "TIP",
}
OTHER_DIRECTORATE = "OTHER"

# Ordered topic rules; the first pattern found in the lower-cased
# title decides. Patterns match inside words on purpose.
TOPIC_RULES = [
    ("climate / environment", "climate|environment|sustain|carbon|emission|warming"),
    (
        "DEI / broadening",
        "diversity|equity|inclusion|broadening|underrepresent|minority|hispanic|indigenous|tribal",
    ),
    (
        "education / training",
        "teach|teacher|education|stem|undergraduate|graduate|student|curricul|k-12|k12",
    ),
    ("health / biomedical", "health|disease|covid|cancer|biomed|medical"),
    ("social / behavioral", "social|behavior|economic|society|community|civic|public"),
    (
        "computing / AI",
        "quantum|computing|ai|machine learning|cyber|data|algorithm|software",
    ),
    ("energy", "energy|battery|solar|wind|nuclear"),
    ("physical sci", "physics|chemistry|astronomy|materials|nano"),
]
OTHER_TOPIC = "other / uncategorized"

# Order in which topics are shown.
TOPIC_ORDER = [
    "DEI / broadening",
    "education / training",
    "social / behavioral",
    "climate / environment",
    "health / biomedical",
    "computing / AI",
    "energy",
    "physical sci",
    "other / uncategorized",
]

# Glossary of directorate codes.
DIRECTORATE_NAMES = [
    ("CISE", "Computer & Information Science and Engineering"),
    ("ENG", "Engineering"),
    ("MPS", "Mathematical and Physical Sciences"),
    ("BIO", "Biological Sciences"),
    ("GEO", "Geosciences"),
    ("SBE", "Social, Behavioral and Economic Sciences"),
    ("EDU", "STEM Education"),
    ("TIP", "Technology, Innovation and Partnerships"),
    ("OD", "Office of the Director"),
    ("OIA", "Office of Integrative Activities"),
    ("OPP", "Office of Polar Programs"),
]


def directorate_of(cfda: Column) -> Column:
    """Directorate code of an exact CFDA code; anything else, NULL too, is OTHER."""
    pairs = [F.lit(x) for item in CFDA_DIRECTORATES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), cfda), F.lit(OTHER_DIRECTORATE))


def directorate_code(value: Column) -> Column:
    """Directorate code of an agency code or a long name; other values stay.

    Award rows hold codes (CISE), the agency table prefixed ones (NSF-CSE), and
    the tracker may hold names.
    """
    names = [F.lit(x) for code, name in DIRECTORATE_NAMES for x in (name.upper(), code)]
    bare = F.regexp_replace(value, "^NSF-", "")
    known = F.try_element_at(F.create_map(*names), F.upper(F.trim(value)))
    return F.coalesce(known, F.when(bare == "CSE", "CISE").otherwise(bare))


def topic_of(title: Column) -> Column:
    """Topic of a project title: first matching rule wins."""
    lowered = F.lower(title)
    (first_label, first_pattern), *rest = TOPIC_RULES
    chain = F.when(lowered.rlike(first_pattern), first_label)
    chain = reduce(lambda c, rule: c.when(lowered.rlike(rule[1]), rule[0]), rest, chain)
    return chain.otherwise(OTHER_TOPIC)


def cfda_text(code: Column) -> Column:
    """Repair a code that some reader turned into a number: 47.05 -> '47.050'."""
    return F.format_string("%.3f", code.cast("double"))
