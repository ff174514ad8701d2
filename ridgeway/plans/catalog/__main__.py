"""List the catalogue: ``python -m ridgeway.plans.catalog``."""

from . import ORACLE, QUERIES


def main() -> None:
    width = max(len(n) for n in QUERIES)
    for name in sorted(QUERIES):
        doc = (QUERIES[name].__doc__ or "").strip().split("\n")[0]
        mark = "sql " if name in ORACLE else "rows"
        print(f"{name:<{width}}  {mark}  {doc}")
    print(f"\n{len(QUERIES)} queries, {len(ORACLE)} with oracle SQL")


if __name__ == "__main__":
    main()
