"""Print a compact view of the executed physical plan of registered queries:
exchanges, aggregates, joins, expands, windows and scans (with ReadSchema)."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from vatio.registry import QUERIES  # noqa: E402
from vatio.session import get_session  # noqa: E402

KEEP = ("Exchange", "Aggregate", "Join", "Expand", "Window", "Scan", "Generate", "ArrowEval",
        "MapInPandas", "FlatMapGroupsInPandas", "Union")


def compact(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        indent = len(line) - len(line.lstrip(" :+-"))
        text = line.strip(" :+-")
        text = re.sub(r"#\d+L?", "", text)
        text = re.sub(r"\[plan_id=\d+\]", "", text)
        if "FileScan" in text:
            tbl = re.search(r"/([A-Za-z_0-9.-]+)\]", text)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", text)
            text = f"Scan {tbl.group(1) if tbl else ''} {rs.group(1) if rs else ''}"
        elif "Aggregate" in text:
            text = re.sub(r"functions=\[.*", "", text)
        elif "Exchange" in text:
            text = re.sub(r", ENSURE_REQUIREMENTS.*|, REBALANCE.*", "", text)
        elif "Expand" in text:
            text = "Expand"
        out.append(" " * (indent // 3) + text[:150])
    return out


def main():
    sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", shuffle_partitions=8)
    for name in sys.argv[1:]:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        print(f"### {name}\n```")
        print("\n".join(compact(plan)))
        print("```\n")


if __name__ == "__main__":
    main()
