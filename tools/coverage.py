"""Print the table of operators and registered queries for README.md."""
from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lumenframe.plans import registry


def main() -> None:
    by_id: dict[str, list[str]] = {}
    for name, q in registry().items():
        by_id.setdefault(q.ident, []).append(f"`{name}`" + ("" if q.sql else " (rows)"))
    order = "SPCJAWXTVLMEHGOU"
    for ident in sorted(by_id, key=lambda i: (order.index(i[0]), i)):
        print(f"| {ident} | {', '.join(by_id[ident])} |")


if __name__ == "__main__":
    main()
