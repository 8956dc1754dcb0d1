"""The month directories of a scan, and the schemas of their files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from launchtide.schemas import require

#: Schemas that are looked up at once.
THREADS = 16
_GLOB = re.compile(r"[*?\[\]{}]")


def _matches(glob: str) -> re.Pattern[str]:
    """A directory glob with ``* ? [..] {a,b}`` as a pattern."""
    known = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|"}
    depth, out = 0, []
    for part in re.split(r"(\[[^\]]*\]|[*?{},])", glob):
        depth += (part == "{") - (part == "}")
        if part.startswith("["):
            out.append(part.replace("[!", "[^"))
        else:
            out.append(known[part] if part in known and (part != "," or depth) else re.escape(part))
    return re.compile("".join(out))


def distinct_names(names: Iterable[str | int]) -> list[str]:
    """Month names and globs of which no two name the same directory.

    Globs become one, which finds each directory once; a name that it matches goes.
    """
    names = list(dict.fromkeys(str(name) for name in names))
    globs = [name for name in names if _GLOB.search(name)]
    known = [_matches(glob) for glob in globs]
    plain = [n for n in names if n not in globs and not any(k.fullmatch(n) for k in known)]
    return plain + ([globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"] if globs else [])


def found_directories(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The directories that paths and globs stand for; a path that finds none stays as it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = []
    for path in paths:
        glob = hadoop(path)
        known = glob.getFileSystem(conf).globStatus(glob) or []
        own = [str(x.getPath().toString()) for x in known if x.isDirectory()]
        found += own or [path]
    return found


def schema_of(spark: SparkSession, path: str, options: Mapping[str, str]) -> T.StructType | None:
    """The schema that a file below a directory has; None if there is no file."""
    try:
        return spark.read.options(**options).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def _narrowed(found: T.DataType, wanted: T.DataType) -> T.DataType:
    """The members of ``wanted`` with the types that they have in ``found``."""
    if isinstance(wanted, T.StructType):
        return T.StructType([T.StructField(f.name, _narrowed(found[f.name].dataType, f.dataType)) for f in wanted])
    if isinstance(wanted, T.ArrayType):
        return T.ArrayType(_narrowed(found.elementType, wanted.elementType))
    return found


def by_schema(
    spark: SparkSession, directories: Iterable[str], wanted: T.StructType, what: str, options: Mapping[str, str]
) -> list[tuple[T.StructType, list[str]]]:
    """Directories in groups of one schema to read them by; those without files are left out.

    Each directory's schema is looked up in one of its files, some at a time. A directory that
    lacks a member of ``wanted``, or has it with another type, is an error that names it.
    Directories with all the same members are one group and keep them all; otherwise only the members
    of ``wanted`` are read, in a group for each kind of timestamp.
    """
    directories = list(directories)
    with ThreadPoolExecutor(THREADS) as pool:
        schemas = list(pool.map(lambda path: schema_of(spark, path, options), directories))
    known = [(path, schema) for path, schema in zip(directories, schemas, strict=True) if schema is not None]
    for path, schema in known:
        require(schema, wanted, f"{what} at {path}")
    if len({schema.json() for _, schema in known}) == 1:
        return [(known[0][1], [path for path, _ in known])]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in known:
        own = _narrowed(schema, wanted)
        groups.setdefault(own.json(), (own, []))[1].append(path)
    return list(groups.values())
