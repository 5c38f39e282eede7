"""JSON extraction with scalar-only semantics.

A document is parsed once into a VARIANT (``parse_doc``); extractions read the
variant. Put the parse in its own ``select`` so the plan keeps one parse per
row under any number of path reads.

Semantics (hazard H3 of the design notes): a *scalar* read of a path yields the
text of a string/number/boolean and NULL for an object, an array, JSON null,
an absent path or a malformed document. Plain ``get_json_object`` returns the
text of objects and arrays instead, which changes which fallback wins.

The VARIANT parser refuses valid documents that repeat a key, or hold a string of
over 20 M characters. These are read from their text instead, row by row and only
where the parser refused: **of a repeated key the first value that is not null
counts**, at every level. A string in such a document that is itself the text of
an object or array is taken for one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_doc(text) -> Column:
    """JSON text -> VARIANT; malformed text and NULL give NULL."""
    return F.try_parse_json(_c(text))


def _sub(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, F.lit(path), "variant") if path != "$" else doc


def is_container(v: Column) -> Column:
    """True when the variant holds an object or an array.

    Decided by the first character of its JSON rendering: ``{`` or ``[`` only
    for containers, since a string renders quoted. This keeps the generated
    code small (type-cast probes per path overflow the 64 KB method limit of
    whole-stage code generation on wide extractions).
    """
    return F.substring(F.to_json(v), 1, 1).isin("{", "[")


def json_scalar(doc, path: str = "$") -> Column:
    """Text of the scalar at ``path`` of a VARIANT document, else NULL."""
    sub = _sub(_c(doc), path)
    return F.when(~is_container(sub), sub.cast("string"))


# No limit on strings; the default parser gives up at 20 M characters.
WHOLE = {"maxStringLen": "2147483647", "maxNestingDepth": "100000"}
VARIANT_STRING_LIMIT = 20_000_000


def object_fields(text) -> Column:
    """``map<string,string>`` of a JSON object's text; NULL for anything else."""
    return F.from_json(_c(text), "map<string,string>", WHOLE)


def array_texts(text) -> Column:
    """``array<string>`` of a JSON array's elements: strings bare, other values as JSON text."""
    return F.from_json(_c(text), "array<string>", WHOLE)


def text_scalar(text, path: str) -> Column:
    """Text of the scalar at ``path`` of a JSON text, read without parsing it into a VARIANT."""
    raw = F.get_json_object(_c(text), path)
    first = F.substring(raw, 1, 1)
    container = (F.when(first == "{", object_fields(raw).isNotNull())
                 .when(first == "[", array_texts(raw).isNotNull()).otherwise(F.lit(False)))
    return F.when(~container, raw)


def object_scalar(text, path: str) -> Column:
    """Text of the scalar at ``path`` of a JSON object's text, else NULL: ``json_scalar`` of the parsed
    text, or ``text_scalar`` of a valid object that the VARIANT parser refuses."""
    text = _c(text)
    doc = parse_doc(text)
    return (F.when(doc.isNotNull(), json_scalar(doc, path))
            .when(object_fields(text).isNotNull(), text_scalar(text, path)))


def array_scalars(text, doc, path: str) -> Column:
    """``array<string>``: the scalar at ``path`` of every element of a JSON array, NULL where there is none.

    ``doc`` is the parsed ``text``; where the parser refused it, the elements are read from the text.
    NULL when the text is no array.
    """
    doc = _c(doc)
    return (F.when(doc.isNotNull(), F.transform(json_array(doc), lambda e: json_scalar(e, path)))
            .otherwise(F.transform(array_texts(text), lambda e: text_scalar(e, path))))


def rebuilt_object(text, paths: Sequence[str]) -> Column:
    """JSON text of an object of the values at ``paths`` of a valid object, with no key twice; else NULL.

    For documents that the VARIANT parser refuses. Paths have one or two levels. The object is put together from the text of the values, each read by
    its path; it is one expression over an array of paths, however many there are. A value that is a
    string beyond the parser's limit is left out.
    """
    text = _c(text)
    below: dict[str, list[str]] = {}
    for p in paths:
        head, _, rest = p[2:].partition(".")
        below.setdefault(head, []).extend([rest] if rest else [])
    wrapped = F.concat(F.lit("["), text, F.lit("]"))   # strings stay quoted behind a wildcard

    def read(names: Column, path) -> Column:
        """The names with the text of the value at ``path(name)``, each read once; without those that have none."""
        pairs = F.transform(names, lambda x: F.struct(x.alias("x"), F.call_function(
            "get_json_object", wrapped, F.concat(F.lit("$[*]."), path(x))).alias("raw")))
        return F.filter(pairs, lambda p: p["raw"].isNotNull() & (
            (F.length(p["raw"]) <= VARIANT_STRING_LIMIT) | F.substring(p["raw"], 1, 1).isin("{", "[")))

    def together(pairs: Column, name, value) -> Column:
        members = F.transform(pairs, lambda p: F.concat(F.lit('"'), name(p["x"]), F.lit('":'), value(p["x"], p["raw"])))
        return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))

    def leaf(raw: Column) -> Column:
        """What the parser refuses is a container: its kind, and an array's length, are all that is read from it."""
        first = F.substring(raw, 1, 1)
        return (F.when(F.try_parse_json(raw).isNotNull(), raw)
                .when(first == "[", F.to_json(F.transform(array_texts(raw), lambda e: F.substring(e, 1, 1))))
                .when(first == "{", "{}").otherwise("null"))

    def field(x: Column, raw: Column) -> Column:
        nested = together(read(x["below"], lambda c: F.concat(x["name"], F.lit("."), c)), lambda c: c, lambda _, r: leaf(r))
        return F.when((F.substring(raw, 1, 1) == "{") & F.try_parse_json(raw).isNull(), nested).otherwise(leaf(raw))
    known = F.array(*[F.struct(F.lit(h).alias("name"), F.array(*map(F.lit, c)).cast("array<string>").alias("below"))
                      for h, c in below.items()])
    whole = together(read(known, lambda x: x["name"]), lambda x: x["name"], field)
    return F.when(object_fields(text).isNotNull(), whole)


def json_subtree(text, path: str, doc=None) -> Column:
    """Compact JSON text of the value at ``path``; NULL when absent, JSON null or malformed.

    Objects and arrays are cut from the source text, so their keys keep the
    original order (a VARIANT renders keys sorted). Scalars are rendered from
    the VARIANT, so a string stays a quoted JSON string.
    """
    doc = parse_doc(text) if doc is None else _c(doc)
    sub = _sub(doc, path)
    return (F.when(is_container(sub), F.get_json_object(_c(text), path))
            .when(~F.is_variant_null(sub), F.to_json(sub)))


def json_array(doc, path: str = "$") -> Column:
    """``array<variant>`` of the array at ``path``; NULL when it is not an array."""
    return F.try_variant_get(_c(doc), F.lit(path), "array<variant>")


def json_array_length(doc, path: str = "$") -> Column:
    """Element count of the array at ``path``; 0 when absent or not an array."""
    return F.coalesce(F.array_size(json_array(doc, path)), F.lit(0))


def _split(path: str) -> tuple[str, str]:
    """'$.a.b.c' -> ('a', '$.b.c'); '$.a' -> ('a', '$')."""
    head, _, rest = path[2:].partition(".")
    return head, (f"$.{rest}" if rest else "$")


class JsonRecord:
    """A JSON document of which many paths are read, the paths being data.

    The text is parsed once and cast once into a struct of its top-level fields as VARIANTs. The
    values at all paths are put into one array, and one higher-order function turns them into scalar
    texts (another one those at ``subtrees`` into JSON text, a third one those at ``arrays`` into
    lengths). The size of the generated code then doesn't depend on the number of paths: one
    expression a path would go beyond the limit of a compiled method, and the whole stage would lose
    its code after a costly attempt.

    Use ``struct()`` in one ``select`` (alias it), then build the field expressions with ``bind(col)``
    on the result.
    """

    def __init__(self, text, paths: Sequence[str], subtrees: Sequence[str] = (), arrays: Sequence[str] = ()):
        self.text, self.paths = _c(text), list(paths)
        self.subtrees, self.arrays = list(subtrees), list(arrays)
        self.fields = list(dict.fromkeys(_split(p)[0] for p in self.paths))
        self._struct_type = "struct<" + ", ".join(f"`{f}`: variant" for f in self.fields) + ">"
        self._bound: Column | None = None

    def _value(self, doc: Column, path: str) -> Column:
        """VARIANT at ``path`` (NULL when absent or the document is malformed)."""
        head, rest = _split(path)
        if head not in self.fields:
            raise KeyError(f"{head} was not declared for this record")
        v = doc.getField(head)
        return v if rest == "$" else F.try_variant_get(v, F.lit(rest), "variant")

    def _reads(self, doc: Column) -> Column:
        def at(paths: Sequence[str]) -> Column:
            return F.array(*[self._value(doc, p) for p in paths]).cast("array<variant>")

        def subtree(v: Column, path: Column) -> Column:
            cut = F.call_function("get_json_object", self.text, path)
            return F.when(is_container(v), cut).when(~F.is_variant_null(v), F.to_json(v))
        return F.struct(
            F.transform(at(self.paths), lambda v: F.when(~is_container(v), v.cast("string"))).alias("scalars"),
            F.zip_with(at(self.subtrees), F.array(*map(F.lit, self.subtrees)).cast("array<string>"), subtree).alias("subtrees"),
            F.transform(at(self.arrays), lambda v: F.coalesce(F.array_size(F.try_variant_get(v, F.lit("$"), "array<variant>")),
                                                              F.lit(0))).alias("lengths"))

    def struct(self) -> Column:
        # The second argument is worked out only where the first is NULL.
        doc = F.coalesce(*[F.try_variant_get(parse_doc(t), F.lit("$"), self._struct_type)
                           for t in (self.text, rebuilt_object(self.text, self.paths))])
        # An array of one binds the parsed document to a name: it is worked out once for all reads.
        return F.get(F.transform(F.array(doc), self._reads), 0)

    def bind(self, struct_col) -> JsonRecord:
        self._bound = _c(struct_col)
        return self

    def _part(self, kind: str, known: Sequence[str], paths: Sequence[str]) -> Column:
        """The reads of ``paths`` as an array: a slice where they were declared side by side."""
        reads, spots = self._bound.getField(kind), [known.index(p) for p in paths]
        if spots == list(range(spots[0], spots[0] + len(spots))):
            return F.slice(reads, spots[0] + 1, len(spots))
        return F.array(*[F.get(reads, i) for i in spots])

    def scalar(self, path: str) -> Column:
        return F.get(self._bound.getField("scalars"), self.paths.index(path))

    def subtree(self, path: str) -> Column:
        return F.get(self._bound.getField("subtrees"), self.subtrees.index(path))

    def first_scalar(self, paths: Sequence[str], convert=None, default=None,
                     convert_each: bool = True) -> Column:
        texts = self._part("scalars", self.paths, paths)
        if convert is not None and convert_each:
            texts = F.transform(texts, convert)
        picked = _first_present(texts)
        if convert is not None and not convert_each:
            picked = convert(picked)
        if default is not None:
            picked = F.coalesce(picked, default if isinstance(default, Column) else F.lit(default))
        return picked

    def first_subtree(self, paths: Sequence[str]) -> Column:
        return _first_present(self._part("subtrees", self.subtrees, paths))

    def array_length(self, path: str) -> Column:
        return F.coalesce(F.get(self._bound.getField("lengths"), self.arrays.index(path)), F.lit(0))


def _first_present(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), 0)
