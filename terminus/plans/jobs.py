"""The jobs of jobs/ as queries: each runs twice into the same new folder, so what is returned has seen a rerun."""

from __future__ import annotations

from pathlib import Path

import jobs
from jobs import motif_scan, site_catalogue
from terminus.operators import annotate
from terminus.plans import bindings as B
from terminus.plans.registry import _CW, _DP, _K, _MAP, _NEARBY, _motif_sql, query
from terminus.staging import fresh


def config(name: str) -> str:
    """The config file of a job, which is a file of this repository on the driver's machine."""
    return str(Path(jobs.__file__).with_name(f"{name}.json").resolve())


_SCAN = " UNION ALL ".join(
    f"SELECT chromosome, CAST(k AS INT) AS k, site_position, strand, '{m.lower()}' AS motif_model, motif, position, motif_type, search_level, motif_support, cleavage_context, u_rich_fraction FROM ({_motif_sql(m, 'pos AS site_position, strand')})"
    for m in annotate.STEPS
)


@query("job1_motif_scan", _SCAN)
def job1(spark, sf):
    output = fresh(spark, "motif-scan")
    motif_scan.run(spark, f"{sf}/documents.parquet", output, config("motif_scan"))
    return motif_scan.run(spark, f"{sf}/documents.parquet", output, config("motif_scan"))


_SEGMENTED = f"{_DP}, gap AS (SELECT ev.*, c.cluster_number FROM pos JOIN numbered c ON pos.gene = c.gene AND pos.i BETWEEN c.s AND c.e JOIN ev ON {' AND '.join(f'ev.{k} = pos.{k}' for k in _K.split(', '))} AND ev.site_position = pos.x), {_NEARBY}, {_MAP}"


@query("job2_site_catalogue", f"{_SEGMENTED} SELECT {_K}, site_position, cluster_key, unified_ID, cluster_start, cluster_end, cluster_width, n_unique_positions, mode_site_position, mode_score, mode_local_n_samples, mode_local_total_site_count, mode_exact_n_samples, mode_exact_total_site_count FROM cmap")
def job2(spark, sf):
    output, checkpoint = fresh(spark, "site-catalogue"), fresh(spark, "site-catalogue-checkpoint")
    incoming = f"{sf}/lineitem*.parquet"  # a pattern: a stream can't begin at the path of one file
    site_catalogue.run(spark, incoming, output, checkpoint, config("site_catalogue"))
    return site_catalogue.run(spark, incoming, output, checkpoint, config("site_catalogue"))
