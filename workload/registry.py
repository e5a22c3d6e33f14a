"""Registration of queries and the views they share.

A view is one statement both engines run. ``{name}`` stands for a table of the
test data or another view.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mattercat.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    "ds": """
        SELECT concat('DS_', lpad(cast(s_suppkey AS string), 6, '0'), '_0') AS id, s_name AS name,
               s_nationkey AS group_key, s_acctbal AS score
        FROM {supplier}""",
    "po": """
        SELECT concat('PO_', lpad(cast(l_orderkey AS string), 8, '0'), '_', cast(l_linenumber AS string)) AS id,
               concat('CO_', lpad(cast(l_partkey AS string), 8, '0')) AS configuration_id,
               concat('DS_', lpad(cast(l_suppkey AS string), 6, '0'), '_0') AS dataset_id,
               cast(l_quantity AS int) AS multiplicity,
               CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS free_energy,
               l_extendedprice * (1 - l_discount) AS potential_energy,
               CASE l_returnflag WHEN 'A' THEN 'eV' WHEN 'N' THEN 'hartree' ELSE 'kcal/mol' END AS energy_unit,
               CASE WHEN l_tax > 0.04 THEN l_tax END AS energy_reference,
               l_linestatus = 'F' AS energy_per_atom,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS formation_energy,
               l_returnflag AS method, l_shipdate AS last_modified
        FROM {lineitem}""",
    "co": """
        SELECT concat('CO_', lpad(cast(p_partkey AS string), 8, '0')) AS id, p_size AS nsites,
               concat('[', chr(39), p_name, chr(39), ', ', chr(39), p_brand, chr(39), ', ', chr(39), p_name, chr(39), ']') AS names,
               concat('[[', cast(p_size % 3 AS string), '.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]') AS cell,
               CASE WHEN p_partkey % 7 = 0 THEN NULL
                    WHEN p_partkey % 2 = 0 THEN concat('/mnt/blobs/MD/', cast(p_partkey % 200 AS string))
                    ELSE concat('/mnt/blobs/data/MD/', cast(p_partkey % 200 AS string)) END AS metadata_path,
               concat('[', cast(p_partkey % 2 = 0 AS string), ']') AS flag_text,
               p_brand AS label
        FROM {part}""",
    "cs": "SELECT DISTINCT concat('CS_', p_brand) AS id, p_brand AS name FROM {part}",
    "cs_co_map": """
        SELECT concat('CS_', p_brand) AS configuration_set_id,
               concat('CO_', lpad(cast(p_partkey AS string), 8, '0')) AS configuration_id
        FROM {part}""",
    # Owner of each set: the dataset of the first structure in it.
    "cs_owned": """
        SELECT m.configuration_set_id AS id, min(p.dataset_id) AS dataset_id
        FROM {cs_co_map} m JOIN {po} p ON p.configuration_id = m.configuration_id
        GROUP BY m.configuration_set_id""",
    "metadata": "SELECT concat('data/MD/', cast(doc_id AS string)) AS path, text AS content FROM {documents}",
    # One row per line item; n x 3 numbers are built from these by each engine.
    "sites": """
        SELECT concat('PO_', lpad(cast(l_orderkey AS string), 8, '0'), '_', cast(l_linenumber AS string)) AS id,
               concat('DS_', lpad(cast(l_suppkey AS string), 6, '0'), '_0') AS dataset_id,
               l_linenumber AS n, l_quantity AS q, l_discount AS d, l_tax AS t, l_partkey AS partkey
        FROM {lineitem}""",
    # Distinct (structure, dataset) pairs.
    "member": "SELECT DISTINCT configuration_id, dataset_id FROM {po}",
}

NAME = re.compile(r"\{(\w+)\}")


def oracle(sql: str) -> str:
    """Expand the views a statement names into common table expressions."""
    ctes: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in NAME.findall(text):
            if name in VIEWS and name not in ctes:
                visit(VIEWS[name])
                ctes[name] = NAME.sub(r"\1", VIEWS[name]).strip()

    visit(sql)
    body = NAME.sub(r"\1", sql).strip()
    if not ctes:
        return body
    heads = ", ".join(f"{name} AS ({text})" for name, text in ctes.items())
    own = body.removeprefix("WITH ")
    return f"WITH {heads}, {own}" if own != body else f"WITH {heads} {body}"


class Tables:
    """The test tables and views of one scale, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.sql(VIEWS[name])
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL over tables, views and given frames, all written ``{name}``."""
        found = {n: frames[n] if n in frames else getattr(self, n) for n in set(NAME.findall(text))}
        return self.spark.sql(text, **found)

    def fresh(self, label: str) -> str:
        return new_folder(self.spark, label)

    def fresh_name(self, label: str) -> str:
        return f"{label}_{uuid.uuid4().hex[:12]}"


def query(key: str, sql: str | None = None):
    """Register a query under its key, with its oracle if SQL can state it."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return build

    return register
