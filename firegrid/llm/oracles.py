"""DuckDB SQL for the registered queries that SQL can express."""

from firegrid.llm import hosts, mixing, prefix_tree, quality

ORACLES: dict[str, str] = {
    "op2_quality": quality.ORACLE, "op4_mixing": mixing.ORACLE, "op7_hosts": hosts.ORACLE, "op13_prefix_tree": prefix_tree.ORACLE,
}
