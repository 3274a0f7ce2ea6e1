"""Jobs given as one flat map of string properties.

The names are a closed set: a property is read, or it is listed as one that
only tunes another engine (task counts, buffers, hosts, region settings), or
the job is refused.  What cannot be expressed by properties alone (a user
hook, a connection kept out of the map) is passed as an argument.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import field
from millrace.operators import cells
from millrace.operators.hooks import map_lines
from millrace.operators.project import split_column_function
from millrace.plans.macros import substitute
from millrace.plans.spec import JobSpec, SpecError, parse_defaults, parse_mapping
from millrace.sinks.cells import delete, put, write_bulk
from millrace.sinks.jdbc import write_table
from millrace.sinks.tables import insert_into, split_statements
from millrace.sinks.text import publish_path, write_delimited, write_sequence
from millrace.sources.archives import read_mixed_lines
from millrace.sources.hadoop import read_query, read_sequence
from millrace.sources.jdbc import Database, read_by_range, read_table
from millrace.session import collect_small
from millrace.sources.ranges import bind, parameter_list
from millrace.sources.text import parse_fields

# Property names.
INPUT_TYPE = "input.sys.mr.mapred.type"
OUTPUT_TYPE = "output.sys.mr.mapred.type"
INPUT_FIELDS = "input.sys.mr.mapred.field.names"
OUTPUT_FIELDS = "output.sys.mr.mapred.field.names"
MAPPING = "output.sys.mr.mapred.group.field.method.rel"
MAP_OPS = "input.sys.mr.mapred.map.senior.conf"
REDUCE_OPS = "output.sys.mr.mapred.reduce.senior.conf"
MAP_KEEP = "input.sys.mr.mapred.map.filter.flag"
REDUCE_KEEP = "output.sys.mr.mapred.map.filter.flag"
DEFAULTS = "output.sys.mr.maperd.outcolumn.default.value"
VALIDATE_ONLY = "input.sys.mr.mapred.only.filter.not.storage"
REJECT_PATH = "input.sys.mr.mapred.map.senior.filter.output.path"
MAP_PLUGIN = "input.sys.mr.mapred.map.plugin.classname"
REDUCE_PLUGIN = "output.sys.mr.mapred.reduce.plugin.classname"
CHARSET = "input.file.content.encoding"
INPUT_DIR = "mapreduce.input.fileinputformat.inputdir"
OUTPUT_DIR = "mapreduce.output.fileoutputformat.outputdir"
IN_FIELD_SEP = "input.mr.mapred.file.field.split.chars"
IN_ROW_SEP = "input.mr.mapred.file.rows.split.chars"
NAME_FILTER_ON = "input.mr.mapred.file.is.filter"
NAME_FILTER = "input.mr.mapred.file.regexpathfilter.regex"
NAME_FILTER_INCLUDE = "input.mr.mapred.file.regexpathfilter.regex.type"
SKIP_LINES = "input.mr.mapred.file.skip.rownum"
OUT_FIELD_SEP = "output.mr.mapred.file.field.split.chars"
OUT_ROW_SEP = "output.mr.mapred.file.rows.split.chars"
OUT_COMPRESS = "output.mr.mapred.file.iscompress"
OUT_CODEC = "output.mr.mapred.file.compressCodec"
OUT_CODEC_KIND = "output.mr.mapred.file.compressCodec.type"
IN_QUERY = "input.mr.maperd.hive.query"
OUT_TABLE = "output.mr.maperd.hive.table"
OUT_DDL = "output.mr.maperd.hive.ddl.hql"
OUT_PARTITIONS = "output.mr.mapred.hive.partition.field"
OUT_TARGETS = ("output.sys.mr.mapred.file.target.Path", "output.mr.mapred.file.target.Path", "output.mr.mapred.hive.target.Path")
OUT_MAX_ROWS = "output.mr.mapred.hive.partition.file.maxcount"
CELL_DELETE = "output.mr.maperd.hbase.data.delete.flag"
# Statements run before a database write, in this order.
OUT_STATEMENTS = ("output.mr.mapred.jdbc.table.dropsql", "mapred.rdb.output.table.altersql", "mapred.rdb.output.table.clearsql")
# Names that change a job's result and have no form here; a job that sets one is refused.
REFUSED = (
    "output.mr.mapred.jdbc.data.delete.flag", "output.mr.mapred.jdbc.data.primarykey.fields", "mapred.rdb.output.table.insertsql",
    "input.mr.mapred.file.force.do", "input.mr.mapred.file.joblogid.do", "input.mr.mapred.file.joblogtime.do",
    "input.mr.mapred.file.jobfail",
)
# A query with parameters, which are literals or a query of their own; some columns fill macros by name or place.
RDB_QUERY, RDB_PARAMS, RDB_MACROS = "mapred.rdb.input.querysql", "mapred.rdb.input.query.params", "mapred.rdb.input.query.macro.names"
RDB_IS_MACROS = "input.mr.mapred.query.param.ismacros"
JDBC_BOUNDS = "input.mr.mapred.jdbc.bounding.query"
# Names that only tune another engine: split counts, buffers, hosts, storage settings.  They change no result.
TUNING = (
    "input.sys.mr.mapred.maper.is.combiner", "input.sys.mr.mapred.class", "input.sys.mr.mapred.resource", "input.sys.mr.mapred.data.source.id",
    "input.mr.mapred.fs.default.name", "input.mr.mapred.jdbc.count.query", "input.mr.mapred.hbase.zookeeper.quorum",
    "input.mr.mapred.hbase.zookeeper.znode.parent", "input.mr.mapred.hbase.zookeeper.property.clientPort",
    "input.mr.mapred.hbase.client.scanner.caching", "output.sys.mr.mapred.data.source.id", "output.mr.mapred.fs.default.name",
    "output.mr.maperd.write.buffersize", "output.mr.mapred.hive.partition.write.buffersize", "output.mr.mapred.hive.partition.temp.path",
    "output.mr.mapred.hbase.zookeeper.quorum", "output.mr.mapred.hbase.zookeeper.znode.parent",
    "output.mr.mapred.hbase.zookeeper.property.clientPort", "output.mr.mapred.hbase.client.scanner.caching", "output.mr.maperd.hbase.wal.flag",
    "output.mr.maperd.hbase.set.inmemory", "output.mr.maperd.hbase.set.commit.bufferlength", "output.mr.maperd.hbase.memstore.flushsize",
    "output.mr.maperd.hbase.isdeferredlog.flush", "output.mr.maperd.hbase.hfile.maxfilesize", "output.mr.maperd.hbase.hbasejar.name",
    "output.mr.maperd.hbase.bloomfiltertype", "output.mr.maperd.hbase.colmun.blocksize", "output.mr.maperd.hbase.colmun.compressiontype",
    "output.mr.maperd.hbase.colmun.compactioncompressiontype", "output.mr.mapred.is.optimize.table",
)
JDBC = {
    "url": "mr.mapred.jdbc.url",
    "user": "mr.mapred.jdbc.username",
    "password": "mr.mapred.jdbc.password",
    "table": "mr.mapred.jdbc.table.name",
    "query": "mr.mapred.jdbc.query",
    "where": "mr.mapred.jdbc.conditions",
    "column": "mr.mapred.jdbc.orderby",
    "fetch": "mr.mapred.jdbc.query.fetchsize",
    "batch": "mr.mapred.jdbc.buffer.length",
}
CELLS = {
    "table": "mr.maperd.hbase.table",
    "sep": "mr.maperd.hbase.column.split.sign",
    "layout": "mr.maperd.hbase.column.relation",
    "start": "mr.maperd.hbase.table.query.startrow",
    "stop": "mr.maperd.hbase.table.query.stoprow",
    "filter": "mr.maperd.hbase.table.query.filter",
    "families": "mr.maperd.hbase.table.query.familys",
    "columns": "mr.maperd.hbase.table.query.familycolumns",
    "times": "mr.maperd.hbase.table.query.timerange",
    "time": "mr.maperd.hbase.table.query.timestamp",
    "key": "mr.maperd.hbase.table.rowkeyrule",
    "unique": "mr.maperd.hbase.use.onlyrowkey",
}
TEXT, SEQUENCE = "FILETEXT", "FILESEQUENCE"
CATALOG = ("HIVETEXT", "HIVESEQUENCE", "HIVERCFILE")
CELL_TYPES = ("HBASE", "NHFILE", "NHBASE")
#: Parameter rows of one job; each is the text of a query.
PARAMETER_ROWS = 100_000
DATABASES = ("MYSQLROW", "MYSQLDATA", "ORACLEROW", "ORACLEDATA", "POSTGRESQL", "VERTICA", "RDBNORM")


_FILES_IN = (INPUT_DIR, IN_FIELD_SEP, IN_ROW_SEP, CHARSET, SKIP_LINES, NAME_FILTER_ON, NAME_FILTER, NAME_FILTER_INCLUDE)
_FILES_OUT = (OUTPUT_DIR, OUT_FIELD_SEP, OUT_ROW_SEP, OUT_COMPRESS, OUT_CODEC, OUT_CODEC_KIND, *OUT_TARGETS)
_DATABASE_IN = (*(f"input.{JDBC[k]}" for k in ("url", "user", "password", "table", "query", "where", "column", "fetch")), JDBC_BOUNDS)
_DATABASE_OUT = (*(f"output.{JDBC[k]}" for k in ("url", "user", "password", "table", "batch")), *OUT_STATEMENTS)
_CELLS_IN = tuple(f"input.{CELLS[k]}" for k in ("table", "sep", "layout", "start", "stop", "filter", "families", "columns", "times", "time"))
_CELLS_OUT = (*(f"output.{CELLS[k]}" for k in ("table", "sep", "layout", "key", "unique")), CELL_DELETE, OUTPUT_DIR, *OUT_TARGETS)
#: Names that have an effect, for every job and by type of source and sink.
ANY_TYPE = (
    INPUT_TYPE, OUTPUT_TYPE, INPUT_FIELDS, OUTPUT_FIELDS, MAPPING, MAP_OPS, REDUCE_OPS, MAP_KEEP, REDUCE_KEEP, DEFAULTS, VALIDATE_ONLY,
    REJECT_PATH, MAP_PLUGIN, REDUCE_PLUGIN,
    # How lines are written and where files lie: shared by job templates, without meaning for a type that has no files.
    INPUT_DIR, OUTPUT_DIR, IN_FIELD_SEP, IN_ROW_SEP, OUT_FIELD_SEP, OUT_ROW_SEP,
)
SOURCE_NAMES = {
    TEXT: _FILES_IN, SEQUENCE: (INPUT_DIR, IN_FIELD_SEP), **dict.fromkeys(CATALOG, (IN_QUERY,)), **dict.fromkeys(CELL_TYPES, _CELLS_IN),
    **dict.fromkeys(DATABASES, _DATABASE_IN), "RDBNORM": (*_DATABASE_IN, RDB_QUERY, RDB_PARAMS, RDB_MACROS, RDB_IS_MACROS),
}
SINK_NAMES = {
    TEXT: (*_FILES_OUT, OUT_PARTITIONS, OUT_MAX_ROWS), SEQUENCE: _FILES_OUT, **dict.fromkeys(CATALOG, (OUT_TABLE, OUT_DDL, OUT_PARTITIONS)),
    **dict.fromkeys(CELL_TYPES, _CELLS_OUT), **dict.fromkeys(DATABASES, _DATABASE_OUT),
}


def check_names(p: _Reader, own_source: bool, own_sink: bool) -> None:
    """Every set property of the map is one the job uses, or one known to change no result; any other is an error.

    With a source or sink passed as an argument, the names of any type are accepted for that side.
    """
    kinds = [(p.get(key, "").split(",")[-1].strip(), table, own) for key, table, own in ((INPUT_TYPE, SOURCE_NAMES, own_source), (OUTPUT_TYPE, SINK_NAMES, own_sink))]
    known = {*ANY_TYPE, *TUNING, *REFUSED}
    for kind, table, own in kinds:
        known |= {n for names in table.values() for n in names} if own else set(table.get(kind, ()))
    everywhere = {n for table in (SOURCE_NAMES, SINK_NAMES) for names in table.values() for n in names}
    for name in sorted(p.values):
        if name in known or p.get(name) is None or not name.startswith(("input.", "output.", "mapred.rdb.", "mapreduce.input.", "mapreduce.output.")):
            continue
        if name in everywhere:
            raise SpecError(f"property {name} has no effect with source {kinds[0][0]!r} and sink {kinds[1][0]!r}")
        raise SpecError(f"property {name} is not known")


class _Reader:
    def __init__(self, values: Mapping[str, str]):
        self.values = values

    def get(self, key: str, default: str | None = None) -> str | None:
        value = self.values.get(key)
        return default if value is None or value == "" else value

    def need(self, key: str) -> str:
        value = self.get(key)
        if value is None:
            raise SpecError(f"property {key} is missing")
        return value

    def flag(self, key: str, default: bool) -> bool:
        return (self.get(key) or str(default)).strip().lower() == "true"

    def names(self, key: str) -> list[str]:
        return [n.strip() for n in self.need(key).split(",")]


def job_from_properties(
    properties: Mapping[str, str],
    *,
    macros: Mapping[str, str | None] | None = None,
    run_time: dt.datetime | None = None,
    source: Callable[[SparkSession], DataFrame] | DataFrame | None = None,
    sink: Callable[[DataFrame], None] | None = None,
    row_hook: Callable | None = None,
    group_hook: Callable | None = None,
    line_hook: Callable | None = None,
    partitions: int = 64,
) -> JobSpec:
    """A validated job; ``source``, ``sink`` and the hooks replace what the map names.

    The map-side plugin is ``row_hook``, the reduce-side plugin ``group_hook``;
    ``line_hook`` changes lines of a text source before they are parsed.  A
    property that would change the result and is not known here is an error.

    ``macros`` are filled into every value first, record fields of templates
    stay.  ``run_time`` stamps cells; ``partitions`` bounds parallel database
    reads.
    """
    fields = {n.strip() for key in (INPUT_FIELDS, OUTPUT_FIELDS) for n in (properties.get(key) or "").split(",")}
    p = _Reader({k: substitute(v, macros or {}, fields) if v else v for k, v in properties.items()})
    for key, hook, name in ((MAP_PLUGIN, row_hook, "row_hook"), (REDUCE_PLUGIN, group_hook, "group_hook")):
        if p.get(key) and hook is None:
            raise SpecError(f"the job names a plugin in {key}: pass its Python form as {name}")
    check_names(p, source is not None, sink is not None)
    for key in REFUSED:
        if p.get(key, "false").strip().lower() not in ("false", "0"):
            raise SpecError(f"property {key} is not supported")
    if line_hook and source is None and p.need(INPUT_TYPE).split(",")[-1].strip() != TEXT:
        raise SpecError("a line hook needs a text source")
    rejects = p.get(REJECT_PATH)
    named = [split_column_function(n.lower()) for n in p.names(OUTPUT_FIELDS)]
    mapping = [
        replace(m, dest=split_column_function(m.dest)[0]) for m in parse_mapping(p.need(MAPPING))
    ]
    spec = JobSpec(
        source=source if source is not None else _source(p, partitions, line_hook),
        mapping=mapping,
        input_fields=p.names(INPUT_FIELDS),
        output_fields=[n for n, _ in named],
        column_functions={n: f for n, f in named if f},
        row_hook=row_hook,
        group_hook=group_hook,
        ops=p.get(MAP_OPS, ""),
        post_shuffle_ops=p.get(REDUCE_OPS, ""),
        keep_matching=p.flag(MAP_KEEP, True),
        keep_matching_post=p.flag(REDUCE_KEEP, True),
        defaults={k.lower(): v for k, v in parse_defaults(_default_items(p.get(DEFAULTS, ""))).items()},
        partition_by=[n.strip().lower() for n in p.get(OUT_PARTITIONS, "").split(",") if n.strip()],
        sink=sink or _sink(p, run_time),
        validate_only=p.flag(VALIDATE_ONLY, False),
    )
    if rejects:
        spec.reject_sink = lambda df: write_delimited(df, rejects)
    return spec.validate()


def _default_items(text: str) -> list[str]:
    return [f"[{item}]" for item in text.strip()[1:-1].split("],[")] if text.strip() else []


def _source(p: _Reader, partitions: int, line_hook: Callable | None = None) -> Callable[[SparkSession], DataFrame]:
    kind = p.need(INPUT_TYPE).split(",")[-1].strip()
    fields = p.names(INPUT_FIELDS)
    sep, row_sep = p.get(IN_FIELD_SEP, ","), p.get(IN_ROW_SEP, "\n")
    if kind == TEXT:
        options = {
            "line_sep": row_sep,
            "charset": None if p.get(CHARSET, "utf-8").lower() in ("utf-8", "utf8") else p.get(CHARSET),
            "skip_lines": int(p.get(SKIP_LINES, "0")),
            "provenance": True,
        }
        if p.flag(NAME_FILTER_ON, False) and p.get(NAME_FILTER):
            options |= {"name_regex": p.get(NAME_FILTER), "name_regex_include": p.flag(NAME_FILTER_INCLUDE, True)}
        paths = [x.strip() for x in p.need(INPUT_DIR).split(",")]
        hooked = (lambda df: map_lines(df, line_hook)) if line_hook else (lambda df: df)
        return lambda spark: parse_fields(hooked(read_mixed_lines(spark, paths, **options)), fields, sep, regex=True)
    if kind == SEQUENCE:
        return lambda spark: read_sequence(spark, p.need(INPUT_DIR), fields, sep, regex=True)
    if kind in CATALOG:
        return lambda spark: _positional(read_query(spark, p.need(IN_QUERY)), fields)
    if kind in CELL_TYPES:
        return lambda spark: _cell_rows(spark, p)
    if kind in DATABASES:
        return lambda spark: _positional(_database_rows(spark, p, partitions), fields)
    raise SpecError(f"source type {kind!r} needs the source argument")


def _positional(df: DataFrame, fields: list[str]) -> DataFrame:
    """Columns named by the job, by position."""
    return df.select(*[field(c).alias(f) for c, f in zip(df.columns, fields)])


def _cell_rows(spark: SparkSession, p: _Reader) -> DataFrame:
    get = lambda name: p.get("input." + CELLS[name])
    listed = lambda name: [x.strip() for x in (get(name) or "").split(",") if x.strip()]
    table = spark.table(p.need("input." + CELLS["table"]))
    timed = isinstance(table.schema["ts"].dataType, (T.TimestampType, T.TimestampNTZType))
    at = lambda millis: F.timestamp_millis(F.lit(int(millis))) if timed else int(millis)
    times = listed("times")
    bounds = dict(zip(("min_ts", "max_ts"), map(at, times))) if len(times) == 2 else {}
    if get("time") not in (None, "-1"):
        bounds["at_ts"] = at(get("time"))
    table = cells.scan(
        table,
        start_row=get("start"),
        stop_row=get("stop"),
        families=listed("families"),
        columns=[tuple(c.split(":", 1)) for c in listed("columns")],
        **bounds,
    )
    filters = cells.parse_filters(get("filter")) if get("filter") else ()
    return cells.read_rows(table, cells.parse_layout(p.need("input." + CELLS["layout"])), get("sep") or ",", filters)


def _database(p: _Reader, side: str) -> Database:
    login = {k: p.get(side + JDBC[k]) for k in ("user", "password")}
    return Database(
        p.need(side + JDBC["url"]),
        {k: v for k, v in login.items() if v is not None},
        fetch_size=int(p.get(side + JDBC["fetch"], "10000")),
    )


def parameter_rows(spark: SparkSession, db: Database, text: str) -> list[dict]:
    """Parameter rows of a parameterised query: those of a query, or one row for each listed literal."""
    if text.lstrip()[:6].lower() == "select":
        return [r.asDict() for r in collect_small(read_table(spark, db, text), PARAMETER_ROWS, "parameter rows")]
    return parameter_list(text)


def bound_queries(template: str, rows: list[dict], macros: list[str]) -> list[str]:
    """The query of each parameter row.  ``macros`` name the columns, or their places, that fill macros; the others fill marks."""
    out = []
    for row in rows:
        names = list(row)
        chosen = {names[int(m)] if m.isdigit() and int(m) < len(names) else m for m in macros}
        if not chosen <= set(names):
            raise SpecError(f"macros {sorted(chosen - set(names))} are not among the parameters {names}")
        out.append(bind(template, row, marks=[v for n, v in row.items() if n not in chosen]))
    return out


def _parameterised_rows(spark: SparkSession, p: _Reader, db: Database, partitions: int) -> DataFrame:
    """Each parameter row's query; several share a split when there are more rows than splits."""
    rows = parameter_rows(spark, db, p.need(RDB_PARAMS))
    if not rows:
        raise SpecError(f"{RDB_PARAMS} gives no parameters")
    named = [n.strip() for n in p.get(RDB_MACROS, "").split(",") if n.strip()] if p.flag(RDB_IS_MACROS, True) else []
    queries = bound_queries(p.need(RDB_QUERY), rows, named)
    each = -(-len(queries) // partitions)
    splits = [" UNION ALL ".join(queries[i:i + each]) for i in range(0, len(queries), each)]
    return reduce(DataFrame.union, [read_table(spark, db, q) for q in splits])


def _database_rows(spark: SparkSession, p: _Reader, partitions: int) -> DataFrame:
    db = _database(p, "input.")
    if p.get(RDB_PARAMS):
        return _parameterised_rows(spark, p, db, partitions)
    if p.get(RDB_QUERY):
        return read_table(spark, db, p.need(RDB_QUERY))
    relation = p.get("input." + JDBC["query"]) or p.need("input." + JDBC["table"])
    where, column = p.get("input." + JDBC["where"]), p.get("input." + JDBC["column"])
    if column:
        bounds = p.get(JDBC_BOUNDS)
        found = tuple(collect_small(read_table(spark, db, bounds), 1, "bounds")[0]) if bounds else None
        return read_by_range(spark, db, relation, column, None, partitions, found, where=where)
    return read_table(spark, db, relation, where=where)


def _sink(p: _Reader, run_time: dt.datetime | None) -> Callable[[DataFrame], None]:
    kind = p.need(OUTPUT_TYPE).split(",")[-1].strip()
    order = [split_column_function(n.lower())[0] for n in p.names(OUTPUT_FIELDS)]
    sep, row_sep = p.get(OUT_FIELD_SEP, ","), p.get(OUT_ROW_SEP, "\n")
    codec = p.get(OUT_CODEC, "gzip") if p.flag(OUT_COMPRESS, False) else None
    parts = [n.strip().lower() for n in p.get(OUT_PARTITIONS, "").split(",") if n.strip()]
    if parts and kind not in (TEXT, *CATALOG):
        raise SpecError(f"sink type {kind!r} has no partitions")
    if p.flag(CELL_DELETE, False):
        if kind != "HBASE" or run_time is None:
            raise SpecError("deleting cells needs the HBASE sink type and run_time")
        return lambda df: _delete(df, p, run_time)
    if kind == TEXT:
        rows = int(p.get(OUT_MAX_ROWS, "-1"))
        if rows == 0:
            raise SpecError("the row limit of a file must be positive, or -1 for none")
        return lambda df: write_delimited(
            _in_order(df, order), _place(p, run_time), sep=sep, line_sep=row_sep, compression=codec,
            partition_by=parts, max_rows_per_file=rows,
        )
    if kind == SEQUENCE:
        block = p.get(OUT_CODEC_KIND, "BLOCK").upper() == "BLOCK"
        return lambda df: write_sequence(_in_order(df, order), _place(p, run_time), sep=sep, compression=codec, block=block)
    if kind in CATALOG:
        return lambda df: insert_into(df, p.need(OUT_TABLE), ddl=p.get(OUT_DDL))
    if kind in CELL_TYPES:
        if run_time is None:
            raise SpecError("a cell sink needs run_time")
        return lambda df: _put(df, p, kind, run_time)
    if kind in DATABASES:
        batch = int(p.get("output." + JDBC["batch"], "10000"))
        before = [x for key in OUT_STATEMENTS for x in split_statements(p.get(key, "")) if x.strip()]
        return lambda df: write_table(
            df, _database(p, "output."), p.need("output." + JDBC["table"]), batch_size=batch, pre_sql=before
        )
    raise SpecError(f"sink type {kind!r} needs the sink argument")


def _target(p: _Reader) -> str | None:
    return next((p.get(key) for key in OUT_TARGETS if p.get(key)), None)


def _place(p: _Reader, run_time: dt.datetime | None) -> str:
    """Output folder; with a target path, the folder of this run under it, where results appear when they are whole."""
    if (target := _target(p)) is None:
        return p.need(OUTPUT_DIR)
    if run_time is None:
        raise SpecError("a target path needs run_time, which names the run's folder")
    return publish_path(target, f"{run_time:%Y%m%d%H%M%S}")


def _in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Output fields in their listed order; a field without a mapping is null."""
    return df.select(*[field(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in order])


def _delete(df: DataFrame, p: _Reader, run_time: dt.datetime) -> None:
    """The cells of the output folder without the rows the job names, as a new version under the target path."""
    if _target(p) is None:
        raise SpecError("deleting cells needs a target path for the new version")
    held = df.sparkSession.read.parquet(p.need(OUTPUT_DIR))
    delete(held, df, p.need("output." + CELLS["key"])).write.parquet(_place(p, run_time))


def _put(df: DataFrame, p: _Reader, kind: str, run_time: dt.datetime) -> None:
    layout = cells.parse_layout(p.need("output." + CELLS["layout"]))
    rule, sep = p.need("output." + CELLS["key"]), p.get("output." + CELLS["sep"], ",")
    path, ts = p.need(OUTPUT_DIR), F.lit(run_time)
    if kind == "HBASE":
        put(df, path, rule, layout, ts, sep=sep, unique=p.flag("output." + CELLS["unique"], False))
    else:
        write_bulk(cells.to_cells(df, cells.row_key(rule, df), layout, ts, sep), path)
