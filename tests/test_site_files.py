import random

import pytest

from terminus.operators import unify
from terminus.plans import commands
from terminus.sources import tables
from terminus.sources.tables import PAS_COLUMNS


def write(folder, name, columns, rows, line=None):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\t".join(columns) + "\n" + "".join("\t".join(str(r.get(c, "")) for c in columns) + "\n" for r in rows)
    (folder / name).write_text(text + (line or ""))


def made(n, seed):
    rng = random.Random(seed)
    return [dict(transcript_id=f"T{i % 5}", gene_id=f"G{i % 3}", gene_name=f"N{i % 3}", chromosome="NC_1", strand="+-"[i % 2], site_position=rng.randint(100, 400), site_count=rng.randint(1, 90), site_abundance=0.5, transcript_biotype=rng.choice(["mRNA", "lnc_RNA", "NA"])) for i in range(n)]


def got(df):
    return [tuple(r[c] for c in (*PAS_COLUMNS, "sample_attribute", "sample", "sample_id")) for r in df.collect()]


def want(rows, *sample):
    return [tuple(None if str(r[c]) in tables.NA_TOKENS else str(r[c]) for c in PAS_COLUMNS) + sample for r in rows]


def test_each_table_is_read_by_its_own_header(spark, tmp_path):
    base, a, b, c = tmp_path / "my species (1)+", made(40, 1), made(30, 2), made(20, 3)
    write(base / "tissue" / "leaf", "x.apa_sites.txt", PAS_COLUMNS, a)
    write(base / "tissue" / "root x", "y.apa_sites.txt", PAS_COLUMNS[::-1], b)
    write(base / "culture" / "c+d" / "x_rerun2", "z.apa_sites.txt", ("more", *PAS_COLUMNS[4:], "a_content", *PAS_COLUMNS[:4]), [r | {"more": "m", "a_content": 0.1} for r in c])
    write(base / "catalogue", "s_unified_apa_sites.txt", ("cluster_key", "unified_ID", "original_site_position", *PAS_COLUMNS[:3]), [{"cluster_key": "k"}] * 9)
    rows = tables.pas_files(spark, str(base))
    expected = want(a, "tissue", "leaf", "tissue/leaf/x.apa_sites.txt") + want(b, "tissue", "root x", "tissue/root x/y.apa_sites.txt") + want(c, "culture", "c+d", "culture/c+d/x_rerun2/z.apa_sites.txt")
    assert sorted(map(str, got(rows))) == sorted(map(str, expected))
    ordered = [r["transcript_id"] for r in rows.orderBy("ingest_seq").collect()]
    assert ordered == [r["transcript_id"] for r in c + a + b]


def test_a_second_run_in_the_same_folder_is_the_first_again(spark, tmp_path):
    base = tmp_path / "species"
    write(base / "tissue" / "leaf", "x.apa_sites.txt", PAS_COLUMNS, made(60, 5))
    write(base / "tissue" / "root", "y.apa_sites.txt", PAS_COLUMNS[::-1], made(60, 6))
    one = commands.unify_folder(spark, str(base), str(base), prefix="first", parts=False)
    two = commands.unify_folder(spark, str(base), str(base / "again"), prefix="second", parts=False)
    text = lambda path: sorted(r.value for r in spark.read.text(path).collect())
    assert text(one["sites"]) == text(two["sites"]) and len(text(one["sites"])) > 1


def test_a_table_that_lacks_columns_is_named(spark, tmp_path):
    write(tmp_path / "b" / "s", "x.apa_sites.txt", PAS_COLUMNS, made(3, 1))
    write(tmp_path / "b" / "t", "y.apa_sites.txt", [c for c in PAS_COLUMNS if c not in ("strand", "gene_id")], made(3, 1))
    with pytest.raises(ValueError, match="y.apa_sites.txt: gene_id, strand"):
        tables.pas_files(spark, str(tmp_path / "b"))
    assert [(r["path"].split("/")[-1], r["lack"]) for r in tables.site_headers(spark, str(tmp_path / "b")).orderBy("path").collect()] == [("x.apa_sites.txt", []), ("y.apa_sites.txt", ["gene_id", "strand"])]


def test_folders_without_tables_are_an_error(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        tables.pas_files(spark, str(tmp_path / "none"))
    write(tmp_path / "only", "s_unified_apa_sites.txt", ("unified_ID", "original_site_position"), [])
    with pytest.raises(ValueError):
        tables.pas_files(spark, str(tmp_path / "only"))


def test_links_to_one_file_are_read_once(spark, tmp_path):
    write(tmp_path / "l" / "b", "x.apa_sites.txt", PAS_COLUMNS, made(7, 1))
    (tmp_path / "l" / "a").mkdir()
    (tmp_path / "l" / "a" / "link.apa_sites.txt").symlink_to(tmp_path / "l" / "b" / "x.apa_sites.txt")
    rows = tables.pas_files(spark, str(tmp_path / "l")).collect()
    assert len(rows) == 7 and {r["sample"] for r in rows} == {"a"}


def test_quotes_blank_lines_short_and_long_rows(spark, tmp_path):
    row = made(1, 1)[0]
    write(tmp_path / "q", "x.apa_sites.txt", PAS_COLUMNS, [], '\n"T ""a"""\tG\tN\tNC_1\t+\t5\t6\r\n\n')
    (r,) = tables.pas_files(spark, str(tmp_path / "q")).collect()
    assert (r["transcript_id"], r["site_count"], r["site_abundance"], r["transcript_biotype"]) == ('T "a"', "6", None, None)
    write(tmp_path / "m", "x.apa_sites.txt", PAS_COLUMNS, [row], "\t".join(["x"] * 10) + "\n")
    write(tmp_path / "m" / "n", "y.apa_sites.txt", (*PAS_COLUMNS, "p", "q"), [row])
    (r,) = tables.pas_files(spark, str(tmp_path / "q")).collect()
    assert (r["sample_attribute"], r["sample"], r["sample_id"]) == ("sample", "q", "x.apa_sites.txt")
    with pytest.raises(Exception, match="more fields than columns"):
        tables.pas_files(spark, str(tmp_path / "m")).collect()


def test_broken_rows_still_end_the_job(spark, tmp_path):
    write(tmp_path / "w", "x.apa_sites.txt", PAS_COLUMNS, [made(1, 1)[0] | {"site_position": "0"}])
    with pytest.raises(Exception, match="invalid site_position"):
        unify.strict(tables.pas_files(spark, str(tmp_path / "w"))).collect()


def test_headers_are_found_without_a_sort_of_lines(spark, tmp_path):
    (tmp_path / "a_apa_sites.txt").write_text("\t".join(tables.PAS_COLUMNS) + "\nT\n")
    own = tables.site_headers(spark, str(tmp_path))
    plan = own._jdf.queryExecution().executedPlan().toString()
    scans = [i for i, line in enumerate(plan.splitlines()) if "FileScan" in line]
    assert "ObjectHashAggregate" in plan and scans and "SortAggregate" not in "\n".join(plan.splitlines()[scans[0] - 6 : scans[0]])
    assert own.first()["lack"] == []
