"""Country jobs on small landed folders."""

import json
import os
import zipfile

import pytest

from arealis.plans import belgium, england_wales, northern_ireland, open_boundaries, scotland, singapore, usa
from arealis.sources import boundaries
from arealis.sources import triples as R
from tests.test_geometry import square
from tests.test_tables import wide_rows


def feature(properties, x, y):
    return json.dumps({"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [square(x, y)]}})


def languages(spark):
    return spark.createDataFrame([(c,) for c in ("nld", "fra", "deu", "eng", "cym")], "code string")


@pytest.fixture(scope="module")
def belgian_folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("belgium")
    root, node = "http://data.gov.be/catalog/statbelopen", belgium.NODE_PREFIX
    lines = []
    for key, formats in (("4689", ("XLSX", "TXT")), ("4796", ("TXT",)), ("4726", ("GEOJSON",)), ("595", ("BIN",)), ("1", ("CSV",))):
        s = f"<{node}{key}>"
        lines += [f"<{root}> <{R.DATASET}> {s} .", f'{s} <{R.TITLE}> "T {key}"@en .', f'{s} <{R.DESCRIPTION}> " D "@en .', f"{s} <{R.LANDING_PAGE}> <http://p/{key}> .", f"<http://p/{key}> <{R.LANGUAGE}> <http://l/en> ."]
        for fmt in formats:
            d = f"<http://f/{key}.{fmt.lower()}.zip>"
            lines += [f"{s} <{R.DISTRIBUTION}> {d} .", f"{d} <{R.FORMAT}> <http://publications.europa.eu/resource/authority/file-type/{fmt}> ."]
    (base / "catalogue.nt").write_text("\n".join(lines))
    (base / "languages.nt").write_text(f'<http://l/en> <{R.NOTATION}> "en"^^<{R.ISO_639_1}> .')
    (base / "tables").mkdir()
    (base / "tables" / "4796").write_text("CD_SECTOR|TOTAL\n01A|5\n02B|7\n")
    (base / "tables" / "4689").write_text(
        "CD_REFNIS|CD_NATLTY|CD_CIV_STS|CD_AGE|CD_SEX|MS_POPULATION\n"
        "01000|BEL|1|5|F|4\n01000|BEL|1|5|F|8\n01000|ETR|4|60|M|2\n02000|BEL|1|5|F|3\n03000|BEL|1|5|F|\n"
    )
    cells = []
    for i in range(7):
        municipality = ["01000", "02000", "03000"][min(i // 3, 2)]
        ids = {"cd_sector": f"S{i}", "cd_munty_refnis": municipality, "cd_dstr_refnis": "D1" if i < 6 else "D2", "cd_rgn_refnis": "R", "cd_prov_refnis": "P"}
        stems = {"sector": "cd_sector", "munty": "cd_munty_refnis", "adm_dstr": "cd_dstr_refnis", "rgn": "cd_rgn_refnis", "prov": "cd_prov_refnis"}
        names = {f"tx_{s}_descr_{lang}": f"{lang} {ids[c]}" for s, c in stems.items() for lang in ("nl", "fr", "de")}
        cells.append(feature({**ids, **names}, i, 0))
    (base / "sectors.geojsonseq").write_text("\n".join(cells))
    return str(base)


def test_belgium_catalogue(spark, belgian_folder):
    rows = {r.partition_key: r for r in belgium.Belgium(spark, belgian_folder).catalogue().collect()}
    assert set(rows) == {"4689", "4796", "4726"}
    assert rows["4689"].source_format == "TXT" and rows["4689"].source_archive_file_path == "4689.txt.txt"
    assert rows["4689"].source_documentation_url == "http://p/4689"
    plan = belgium.Belgium(spark, belgian_folder)
    plan.required = None
    assert {r.partition_key for r in plan.catalogue().collect()} == {"4689", "4796", "4726", "1"}


def test_belgium_publishes_a_country_folder(spark, belgian_folder, tmp_path):
    plan = belgium.Belgium(spark, belgian_folder, languages(spark))
    plan.publish(str(tmp_path))
    read = lambda p: spark.read.parquet(f"{tmp_path}/{p}")
    assert set(os.listdir(tmp_path / "bel")) >= {
        "country_metadata.parquet", "data_publishers.parquet", "source_data_releases.parquet", "geometry_metadata.parquet",
        "metric_metadata.parquet", "metrics", "geometries",
    }
    means = {r.GEO_ID: r.asDict() for r in read("bel/metrics/4689.parquet").collect()}
    assert means["01000"] == {"GEO_ID": "01000", "BEL_1_5_F": 6.0, "ETR_4_60_M": 2.0}
    assert means["02000"]["ETR_4_60_M"] is None and "03000" not in means
    totals = {r.GEO_ID: r.TOTAL for r in read("bel/metrics/4796.parquet").collect()}
    assert totals == {"01A": 5, "02B": 7}
    described = {r.metric_parquet_column_name: r for r in read("bel/metric_metadata.parquet").collect()}
    assert described["ETR_4_60_M"].metric_hxl_tag == "#population+adm4+m+age60+non-belgian+divorced"
    assert described["BEL_1_5_F"].metric_human_readable_name == "Population, Belgian, single, female, and age 5"
    assert described["TOTAL"].metric_hxl_tag == "#population+adm5+total+2023" and described["TOTAL"].metric_description == "D"
    names = {r.GEO_ID: r.fra for r in read("bel/geometries/municipality_2023.parquet").collect()}
    assert names == {g: f"fr {g}" for g in ("01000", "02000", "03000")}
    shapes = boundaries.read_feature_lines(spark, f"{tmp_path}/bel/geometries/arrondisement_2023.geojsonseq")
    assert {r.properties["GEO_ID"]: len(r.parts[0][0]) for r in shapes.collect()} == {"D1": 15, "D2": 5}
    assert plan.long_metrics(["4796"]).count() == 2


def test_northern_ireland(spark, tmp_path):
    (tmp_path / "tables/DZ21").mkdir(parents=True)
    g = northern_ireland.TABLE_GEOGRAPHY["DZ21"]
    rows = ["N1,A,3,Aged 3,1,Female,10", "N1,A,10,Aged 10,2,Male,5", "N1,A,40,Aged 40,1,Female,7", "N1,A,40,Aged 40,2,Male,6", "N2,B,40,Aged 40,1,Female,1"]
    (tmp_path / "tables/DZ21/MS-A09.csv").write_text(f"{g} Code,{g} Label,Age Code,Age Label,Sex Code,Sex Label,Count\n" + "\n".join(rows))
    (tmp_path / "tables/DZ21/MS-X.csv").write_text(f"{g} Code,{g} Label,Tenure Code,Tenure Label,Count\nN1,A,1,Owned (all),4\n")
    documents = [
        (f"https://x/{t}", json.dumps({"dc:title": f"{t}: T", "dc:description": "D", "url": "https://x/t?v=LGD14", "tableSchema": {}}))
        for t in ("MS-A09", "MS-X")
    ]
    spark.createDataFrame(documents, "url string, value string").write.parquet(f"{tmp_path}/metadata")
    plan = northern_ireland.NorthernIreland(spark, str(tmp_path))
    assert plan.catalogue().count() == 6
    output = plan.derived_metrics("DZ21/MS-A09")
    got = {r["GEO_ID"]: r.asDict() for r in output.metrics.collect()}
    assert set(got) == {"N1"}
    assert got["N1"]["children_5_17"] == 5 and got["N1"]["individuals"] == 28 and got["N1"]["40_2"] == 6 and got["N1"]["Aged 40_Male"] == 6
    rows = {r.metric_parquet_column_name: r for r in output.metadata.collect()}
    assert set(rows) == set(output.metrics.columns) - {"GEO_ID"}
    assert rows["40_2"].metric_hxl_tag == "#population+Age_40+Sex_2"
    assert rows["Aged 40_Male"].metric_human_readable_name == "Variable: 'Age'; Value: 'Aged 40'; Variable: 'Sex'; Value: 'Male'"
    assert rows["adults"].metric_parquet_path == "gb_nir/metrics/DZ21MSA09.parquet"
    single = plan.derived_metrics("DZ21/MS-X")
    assert single.metrics.columns == ["GEO_ID", "1", "Owned (all)"]

    (tmp_path / "zones_LGD14.geojsonseq").write_text("\n".join(feature({"DZ2021_cd": f"Z{i}"}, i, 0) for i in range(3)))
    (tmp_path / "zone_lookup.csv").write_text("DZ2021_code,LGD2014_cd,LGD2014_name\nZ0,L1,One\nZ1,L1,One\nZ9,L9,Nine\n")
    level = northern_ireland.LEVELS[2]
    from arealis.operators.geometry import level_boundaries, level_names

    layer = plan.boundary_layer(level)
    assert {r.GEO_ID: len(r.parts[0][0]) for r in level_boundaries(layer, level).collect()} == {"L1": 7}
    assert {tuple(r) for r in level_names(layer, level).collect()} == {("L1", "One"), ("L9", "Nine")}


def test_northern_ireland_links(spark):
    index = spark.createDataFrame([("u", '<a href="/en/standard/a"></a><a href="/en/other"></a>')], "url string, html string")
    assert [r.url for r in northern_ireland.standard_table_links(index).collect()] == ["https://build.nisra.gov.uk/en/standard/a"]
    page = spark.createDataFrame([("p", '<a href="/x/table.csv-metadata.json"></a><a href="/x/table.csv?v=1"></a><a href="/x/table.csv?v=2"></a>')], "url string, html string")
    row = northern_ireland.table_links(page).first()
    assert row.table_url.endswith("/x/table.csv?v=1") and row.metadata_url.endswith("/x/table.csv-metadata.json")


@pytest.fixture(scope="module")
def scottish_folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("scotland")
    (base / "archives").mkdir()
    bands = ["All people", "0 to 4", "5 to 9", "10 to 11", "12 to 14", "15", "16 to 17", "18 to 19", "20 to 24"]
    body = [",,All people,Males,Females"]
    for geo in ("S92000003", "S1", "S2"):
        body += [f'{geo},{b},"1,{i:03d}",{i},{"-" if b == "15" else 1000}' for i, b in enumerate(bands)]
    with zipfile.ZipFile(base / "archives" / "Council_Area_blk.zip", "w") as z:
        z.writestr("LC1117SC.csv", "\n".join(body))
        z.writestr("QS103SC.csv", "\n,Total\nS1,3\n".lstrip())
        z.writestr("DC9SC.csv", ",,,Total\nS1,a,b,3\n")
        z.writestr("bulk_output.csv", "x")
        z.writestr("UNLISTED.csv", ",a\nS1,1\n")
    index = ["2A,QS103SC,Age by single year,All people,Age,OA,2011,,"]
    index += [f"3A,LC1117SC,Age by sex,All people,{v},OA,2011,," for v in ("Sex", "Age")]
    index += ["3A,DC9SC,Only one,All people,v,OA,2011,,"]
    (base / "index.csv").write_text("\n".join(index))
    (base / "lookup").mkdir()
    (base / "lookup/oa_council.csv").write_text("OutputArea2011Code,CouncilArea2011Code\nO1,C1\nO2,C1\n")
    (base / "lookup/oa_zones.csv").write_text("OutputArea2011Code,DataZone2011Code,IntermediateZone2011Code\nO1,D1,I1\nO2,D2,I1\n")
    (base / "lookup/zone_names.csv").write_text("DataZone2011Code,DataZone2011Name\nD1,Zone 1\nD2,Zone 2\n")
    (base / "lookup/intermediate_names.csv").write_text("IntermediateZone2011Code,IntermediateZone2011Name\nI1,Inter\n")
    (base / "lookup/council_names.csv").write_text("CouncilArea2011Code,NRSCouncilAreaName\nC1,Council\n")
    (base / "zones_CouncilArea2011.geojsonseq").write_text("\n".join(feature({"DataZone": f"D{i}"}, i, 0) for i in (1, 2, 3)))
    return str(base)


def test_scotland(spark, scottish_folder):
    plan = scotland.Scotland(spark, scottish_folder)
    catalogue = {r.partition_key: r for r in plan.catalogue().collect()}
    assert set(catalogue) == {f"2011/CouncilArea2011/{t}" for t in ("LC1117SC", "QS103SC", "DC9SC")}
    assert catalogue["2011/CouncilArea2011/LC1117SC"].variables == "Sex, Age"
    assert catalogue["2011/CouncilArea2011/LC1117SC"].human_readable_name == "Age by sex (All people)"
    plan.allow_missing = False
    output = plan.derived_metrics("2011/CouncilArea2011/LC1117SC")
    rows = {r["GEO_ID"]: r.asDict() for r in output.metrics.collect()}
    assert set(rows) == {"S1", "S2"}
    one = rows["S1"]
    assert one["children_5_17"] == (2 + 3 + 4 + 5 + 6) + 4 * 1000 and one["infants_0_4"] == 1 + 1000
    assert one["individuals"] == 0 + 1000 and one["adults_m"] == 7 + 8 and one["All people__5 to 9"] == 1002
    described = {r.metric_parquet_column_name: r for r in output.metadata.collect()}
    assert set(described) == set(output.metrics.columns) - {"GEO_ID"}
    assert described["Males__5 to 9"].metric_hxl_tag == "#population+Sex_Males+Age_5to9"
    keyless = plan.derived_metrics("2011/CouncilArea2011/QS103SC")
    assert [tuple(r) for r in keyless.metrics.collect()] == [("S1", 3)]
    with pytest.raises(ValueError, match="do not fit"):
        plan.derived_metrics("2011/CouncilArea2011/DC9SC")
    plan.allow_missing = True
    assert plan.derived_metrics("2011/CouncilArea2011/DC9SC") is None
    assert set(plan.metrics()) == {f"2011/CouncilArea2011/{t}" for t in ("LC1117SC", "QS103SC")}
    outcomes = {r.partition_key.rpartition("/")[2]: (r.status, r.reason) for r in plan.outcomes().collect()}
    assert outcomes["LC1117SC"] == outcomes["QS103SC"] == ("ok", None)
    assert outcomes["DC9SC"][0] == "skipped" and "do not fit" in outcomes["DC9SC"][1]


def test_scottish_geometry(spark, scottish_folder):
    from arealis.operators.geometry import level_boundaries, level_names

    plan = scotland.Scotland(spark, scottish_folder)
    level = scotland.LEVELS[2]
    layer = plan.boundary_layer(level)
    assert {r.GEO_ID: len(r.parts[0][0]) for r in level_boundaries(layer, level).collect()} == {"C1": 7}
    assert {tuple(r) for r in level_names(layer, level).collect()} == {("C1", "Council")}
    assert plan.source_data_releases().count() == len(plan.templates) * 3


def test_england_and_wales(spark, tmp_path):
    rows = wide_rows()
    (tmp_path / "archives").mkdir()
    text = "\n".join([",".join(rows[0]), *[",".join(str(v) for v in r.values()) for r in rows]])
    with zipfile.ZipFile(tmp_path / "archives/census2021-ts009.zip", "w") as z:
        z.writestr("census2021-ts009-ltla..csv", text)
        z.writestr("census2021-ts009-oa.csv", "")
    bulk = (
        "<table><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr><tr><td colspan=4>Demography</td></tr>"
        "<tr><td>TS009</td><td>Sex by age</td><td><a href='/o/census2021-ts009.zip'>census2021-ts009.zip</a></td><td></td></tr></table>"
    )
    spark.createDataFrame([("u", bulk)], "url string, html string").write.parquet(f"{tmp_path}/bulk")
    page = ("https://www.nomisweb.co.uk/datasets/c2021ts009", '<div id="dataset-landing-information"><p> Sex by age </p></div>')
    spark.createDataFrame([page], "url string, html string").write.parquet(f"{tmp_path}/pages")
    plan = england_wales.EnglandAndWales(spark, str(tmp_path))
    catalogue = {r.partition_key: r for r in plan.catalogue().collect()}
    assert len(catalogue) == 6 and catalogue["ltla/TS009"].description == "Sex by age"
    assert catalogue["ltla/TS009"].source_download_url == "https://www.nomisweb.co.uk/o/census2021-ts009.zip"
    outputs = plan.metrics()
    assert set(outputs) == {"ltla/TS009"}
    row = outputs["ltla/TS009"].metrics.filter("GEO_ID = 'E06000001'").first()
    assert (row.children_5_17, row.infants_0_4, row.children_0_17, row.adults_f, row.adults_m, row.adults, row.individuals) == (
        14847, 4981, 19828, 37971, 34548, 72519, 92347,
    )
    described = {r.metric_parquet_column_name: r.metric_hxl_tag for r in outputs["ltla/TS009"].metadata.collect()}
    assert described["adults_f"] == "#population+adults+f"
    assert described["Sex: Male; Age: Total; measures: Value"] == "#population+details_unknown"
    assert set(described) == set(outputs["ltla/TS009"].metrics.columns) - {"GEO_ID"}
    two = spark.createDataFrame([("u", bulk + bulk)], "url string, html string")
    with pytest.raises(ValueError, match="exactly one table"):
        england_wales.bulk_downloads(two)


def test_united_states(spark, tmp_path):
    from workbench.jobs import land_survey

    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    plan = usa.UnitedStates(spark, land_survey(spark, sf), languages(spark))
    plan.years = [2019]
    plan._periods = lambda year: ["oneYear"]
    catalogue = plan.catalogue().collect()
    assert [(r.partition_key, list(r.table_names)) for r in catalogue] == [
        ("2019/oneYear/county/0", ["acsdt1y2019-b01001.dat", "acsdt1y2019-b02001.dat"])
    ]
    output = plan.derived_metrics("2019/oneYear/county/0")
    described = {r.metric_parquet_column_name: r for r in output.metadata.collect()}
    five = described["B01001_E003"]
    assert five.metric_human_readable_name == "Total population, Sex By Age, 2019, oneYear, Under 5 years"
    assert five.metric_hxl_tag == "#TotalPopulation+Total+Male+Under5Years"
    assert five.metric_parquet_margin_of_error_column == "B01001_M003"
    assert five.metric_parquet_margin_of_error_file == five.metric_parquet_path == "usa/metrics/2019oneYearcounty0.parquet"
    assert five.metric_source_download_url.endswith("/2019/prototype/1YRData/acsdt1y2019-b01001.dat")
    assert described["adults"].metric_description == "Adults"
    written = plan.write_outputs([output], str(tmp_path))
    assert len(written) == 2 and "B01001_M001" in spark.read.parquet(written[0]).columns
    geoids = [r.GEO_ID for r in plan.area_names(2019).orderBy("GEO_ID").limit(1).collect()]
    os.makedirs(tmp_path / "areas")
    for level in ("tract", "block_group", "county"):
        cells = [feature({"AFFGEOID": geoids[0]}, 0, 0), feature({"AFFGEOID": "unknown"}, 1, 0)]
        (tmp_path / f"areas/2019_{level}.geojsonseq").write_text("\n".join(cells))
    plan.features = lambda name: boundaries.read_feature_lines(spark, f"{tmp_path}/{name}.geojsonseq")
    level = plan.geometry()[2]
    assert [r.GEO_ID for r in level.boundaries.collect()] == geoids and level.names.count() == 1
    assert level.stem == "usa/geometries/county_2019"


def test_open_boundaries(spark, tmp_path):
    for i, name in enumerate(("county", "parish")):
        (tmp_path / f"layer={name}").mkdir()
        (tmp_path / f"layer={name}" / "a.geojsonseq").write_text("\n".join(feature({"id": str(j)}, j, 0) for j in range(i + 1)))
    layers = open_boundaries.read_layers(spark, str(tmp_path), ["county", "parish"])
    got = {r.title: r.num_records for r in open_boundaries.layer_profiles(layers, ["county", "parish"]).collect()}
    assert got == {"county": 1, "parish": 2}
    with pytest.raises(ValueError, match="missing: high_water"):
        open_boundaries.read_layers(spark, str(tmp_path), ["county", "parish", "high_water"])


def test_singapore(spark, tmp_path):
    html = "<b><tr><th>SUBZONE_N</th> <td>TOWN</td> </tr><tr><th>PLN_AREA_N</th> <td>CORE</td></tr><tr><th>REGION_N</th> <td>EAST</td></tr></b>"
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [json.loads(feature({"Description": html}, 0, 0))]}))
    document = {"Data": {"row": [{"rowNo": "1.1", "rowText": "Town", "columns": [{"key": "Total", "columns": [{"key": "Total", "value": "9"}, {"key": "0 - 4", "value": "2"}]}]}]}}
    (tmp_path / "p.json").write_text(json.dumps(document, indent=1))
    areas = singapore.subzones(boundaries.read_feature_collections(spark, f"{tmp_path}/a.geojson"))
    people = singapore.population(spark, f"{tmp_path}/p.json")
    row = singapore.total_population_areas(areas, people).first()
    assert (row.subzone, row.planning_area, row.region, row.population) == ("TOWN", "CORE", "EAST", 9)


def test_belgian_layer_is_parsed_once_for_all_levels(spark, belgian_folder, monkeypatch):
    plan = belgium.Belgium(spark, belgian_folder)
    parsed, features = [], plan.features
    monkeypatch.setattr(plan, "features", lambda name: parsed.append(name) or features(name))
    layers = [plan.boundary_layer(level) for level in plan.levels]
    assert len(layers) == 5 and parsed == ["sectors"]
    direct = boundaries.with_properties(features("sectors"), layers[0].columns[:-1])
    assert sorted(map(str, layers[4].collect())) == sorted(map(str, direct.collect()))
