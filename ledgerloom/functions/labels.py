"""Which labels can't name a field, and how well a label names it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that name no field.
NEVER = (r"for\s+the\s+years?\s+ended", r"statements?\s+of\s+changes?\s+in", r"we\s+have\s+audited")
# Labels that can't name a field, by field. A pair is a pattern and one that excuses it.
REJECTED = {
    "net_income": (r"per\s*share", r"\beps\b", r"\bdiluted\b", r"\bbasic\b", r"before\s+income\s+tax"),
    "eps_diluted": (r"anti.?dilutive", r"excluded\s+from", r"\badjusted\b", r"non[\s-]?gaap", r"weighted\s+average", r"number\s+of.*shares"),
    "eps_basic": (r"anti.?dilutive", r"excluded\s+from", r"\badjusted\b", r"non[\s-]?gaap", r"weighted\s+average", r"number\s+of.*shares", (r"\bdiluted\b", r"\bbasic\b")),
    "ebit": (r"non[\s-]?gaap", r"loss\s+carryforward"),
    "ingresos": (r"non[\s-]?gaap",),
    "total_assets": (r"discontinued\s+operations",),
    "total_liabilities": (r"liabilities\s+and\s+stockholders", r"liabilities\s+and\s+shareholders", r"liabilities\s+and\s+equity", r"mezzanine\s+equity", r"discontinued\s+operations", r"equity\s+and\s+liabilities", r"\bcurrent\b"),
    "total_equity": (r"liabilities\s+and\s+", r"equity\s+and\s+liabilities", r"discontinued\s+operations"),
    "cash_and_equivalents": (r"restricted\s*cash", (r"cash\s+and\s+cash\s+equiv", r"^cash\b")),
    "gross_profit": (r"per\s+(?:active\s+)?customer", r"per\s+(?:active\s+)?advertiser", r"\bmargin\b"),
    "capex": (r"finance\s+lease", r"accrued\s+but\s+not\s+paid", r"included\s+in\s+accounts\s+payable", r"^\s*accrued\b"),
    "income_tax": (r"before\s+.*income\s+tax", r"accrued\s+income\s+tax", r"prepaid\s+income\s+tax", r"income\s+tax\s+payable", r"cash\s+paid.*income\s+tax", r"cash.*refund.*income\s+tax", r"deferred\s+income\s+tax", r"^add:", r"\bcurrent\s+tax\s+expense", r"\bdeferred\s+tax\s+expense", r"\btaxes\s+paid\b", r"\btaxes\s+received\b", r"taxes\s+other\s+than\s+income", (r"current\s+income\s+tax\b", r"current\s+income\s+tax\s+expense"), r"income\s+tax\s+receivable"),
    "shares_outstanding": (r"par\s+value", r"preferred\s+stock", (r"\bdiluted\b", r"\bbasic\b"), r"^class\s+[a-z]\b", r"shares\s+issued\s+and", r"class\s+[a-z]:"),
    "sga": (r"\bper\s+boe\b", r"\bunallocated\b", r"\bupstream\b", r"non[\s-]?gaap", r"\(\s*[2-9]\d*\s*\)\s*$"),
    "dividends_per_share": (r"\bsupplemental\b", r"\bspecial\s+dividend"),
    "total_debt": (r"\brepayment\b", r"\breceipt\b", r"\bproceeds\b", r"\bsecurities\b", r"fair\s+value\s+adjust", r"assumed\s+to\s+acquire", r"assumed\s+in\s+(?:merger|acquisition)", r"current\s+portion\s+of\s+(?:long.term|lt)\s+debt"),
    "interest_expense": (r"^add:", r"\bpaid\b", r"lease\s+liabilities", r"net\s+financial\s+interest"),
    "depreciation_amortization": (r"^right[\s-]?of[\s-]?use", r"intangible\s+assets\s+acquired", r"\baccumulated\b"),
    "research_and_development": (r"tax\s+credit", r"in[\s-]process"),
}
# Labels that name a field best, by field, in order.
PREFERRED = {
    "total_equity": (r"^total\s+equity$",),
    "ebit": (r"^operating\s+income", r"^operating\s+loss"),
    "net_income": (r"^net\s+income(\s*\(loss\))?\s*$", r"\b(profit|income)\b.{0,60}\bowners\s+of\s+the\s+(company|parent)\b"),
    "cash_and_equivalents": (r"^cash\s+and\s+cash\s+equivalents$",),
    "cfo": (r"net\s+cash\s+(?:provided|used)\s+(?:by|in)\s+operating",),
    "income_tax": (r"^(total\s+)?income\s+tax\s+expense(\s*\(benefit\))?\s*$", r"^income\s+tax$", r"provision\s+for\s+income\s+tax", r"^income\s+tax\s+provision", r"^total\s+(?:expenses?\s+)?\(?income\)?\s+taxes?\s+on\s+income$"),
    "interest_expense": (r"\bgross\s+financing", r"^interest\s+expense"),
    "shares_outstanding": (r"shares\s+used\s+in\s+per\s+share\s+calc", r"weighted\s+average.*shares.*outstanding", r"weighted\s+average\s+common\s+shares", r"\bbasic\b"),
    "ingresos": (r"oil\s+and\s+gas\s+(?:sales|revenues?)\b",),
    "eps_basic": (r"\bincome\s+per\s+share\b",),
    "depreciation_amortization": (r"depreciation.{1,60}amortis[ae]tion", r"depreciation.{1,60}amortization", r"amortis[ae]tion.{1,60}depreciation", r"amortization.{1,60}depreciation", r"^d[d]?&?a\b", r"\bdd&a\b", r"depletion.{1,60}amortis[ae]tion", r"depletion.{1,60}amortization"),
}


def rejected(field: Column, label: Column) -> Column:
    """Whether a label can't name the field."""
    out = F.when(F.lit(False), False)
    for f, patterns in REJECTED.items():
        hit = label.rlike("(?i)" + "|".join(p for p in patterns if isinstance(p, str)))
        for p in patterns:
            if not isinstance(p, str):
                hit |= label.rlike("(?i)" + p[0]) & ~label.rlike("(?i)" + p[1])
        out = out.when(field == f, hit)
    return label.rlike("(?i)" + "|".join(NEVER)) | out.otherwise(False)


def priority(field: Column, label: Column) -> Column:
    """100 if a preferred pattern is all of the label, 50 if it occurs in it; else -10 behind a spaced dash, 0 otherwise."""
    bare, out = F.trim(label), F.when(F.lit(False), 0)
    for f, patterns in PREFERRED.items():
        for p in patterns:
            out = out.when((field == f) & bare.rlike(f"(?i)^(?:{p})$"), 100).when((field == f) & label.rlike("(?i)" + p), 50)
    return out.when(label.contains(" – ") | label.contains(" — "), -10).otherwise(0)
