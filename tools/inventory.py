"""Print the registered queries as a markdown table (used for README.md)."""

import sys

sys.path.insert(0, ".")

from casebook.plans import DOC, ORACLE, QUERIES  # noqa: E402

print("| key | survey id | what it computes | oracle |")
print("|---|---|---|---|")
for qid in sorted(QUERIES):
    base = qid.replace("_intended", "")
    sid = base.upper().replace("_", "-")
    doc = " ".join(DOC[qid].split())
    kind = "intended" if qid.endswith("_intended") else "as written"
    print(f"| `{qid}` | {sid} ({kind}) | {doc} | {'DuckDB' if qid in ORACLE else 'rows only'} |")
