"""Conversations without quotations: quoted passages are linked to the messages they come from.

Lines that begin with one or more ``>`` are quoted, as deep as there are marks. Neighbouring lines of one
depth form a passage. Passages are hashed after folding case and white space, and looked up among the
lines, paragraphs and whole own texts of earlier messages of the conversation. A passage that is none of
these is looked up by its paragraphs and lines. What is left of a message is its own text, placed under the message that it answers. Spark functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystrata.sources.files import checkpointed

_MARKS = r"^(?:[ \\t]*>)+[ ]?"

# A run is cut off by one control character, its depth ends with the other.
_RUNS = f"""
  transform(
    filter(split(array_join(transform(lines, (l, i) -> concat(
      if(i > 0 and get(depths, i - 1) = get(depths, i), '\\n',
         concat(char(1), cast(get(depths, i) as string), char(2))),
      regexp_replace(translate(l, concat(char(1), char(2)), ''), '{_MARKS}', ''))), ''), char(1)),
      r -> r <> ''),
    r -> struct(cast(substring_index(r, char(2), 1) as int) as depth,
                substring_index(r, char(2), -1) as text))
"""
_FOLDED = "trim(regexp_replace(lower({0}), '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+', ' '))"


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``runs`` (depth and text of each run of lines), ``body`` (the text without quotes),
    ``depth`` (of the deepest quote) and ``n_quotes`` (passages)."""
    lined = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n").alias("lines"),
    )
    depths = F.expr(
        f"transform(lines, l -> length(translate(regexp_extract(l, '{_MARKS}', 0), ' \\t', '')))"
    )
    runs = lined.withColumn("depths", depths).withColumn("runs", F.expr(_RUNS))
    return runs.select(
        "conv_id", "turn", "role", "runs",
        F.expr(
            "trim(array_join(transform(filter(runs, r -> r.depth = 0), r -> r.text), '\\n'))"
        ).alias("body"),
        F.expr("coalesce(array_max(depths), 0)").alias("depth"),
        F.expr("size(filter(runs, r -> r.depth > 0))").alias("n_quotes"),
    )


def _links(runs: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to, n_linked)`` of messages with a quote whose source is known.

    Sources and quotes of one text in one conversation are one sorted sequence in which each quote
    takes the last source before it, so nothing is paired off. Only quotes without a source so are
    taken to pieces.
    """
    own = F.expr("filter(runs, r -> r.depth = 0)")
    parts = F.expr(
        "array_distinct(concat(array(body), flatten(transform(own, r -> split(r.text, '\\n'))), "
        "flatten(transform(own, r -> split(r.text, '\\n[ \\\\t]*\\n')))))"
    )
    sources = runs.withColumn("own", own).select(
        "conv_id", "turn", F.lit(0).alias("depth"), F.explode(parts).alias("part"),
        F.lit(None).cast("string").alias("text"),
    )
    quotes = runs.select(
        "conv_id", "turn", F.explode(F.expr("filter(runs, r -> r.depth > 0)")).alias("q")
    ).select("conv_id", "turn", "q.depth", F.col("q.text").alias("part"), "q.text")
    folded = sources.unionAll(quotes).withColumn("part", F.expr(_FOLDED.format("part")))
    hashed = folded.where("part <> '' and conv_id is not null and turn is not null").select(
        "conv_id", "turn", "depth", F.sha2("part", 256).alias("hash"), "text"
    )
    before = (
        Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    )
    source = F.last(F.when(F.col("depth") == 0, F.col("turn")), ignorenulls=True).over(before)
    quoted = checkpointed(hashed.withColumn("source", source).where("depth > 0"))
    found = quoted.where("source is not null").select("conv_id", "turn", "depth", "source")
    loose = quoted.where("source is null and text like '%\n%'")
    if not loose.isEmpty():
        found = found.unionAll(_by_pieces(loose, hashed.where("depth = 0")))
    # The shallowest quote says what is answered; of several the latest source.
    nearest = F.max(F.struct((-F.col("depth")).alias("d"), F.col("source")))
    return found.groupBy("conv_id", "turn").agg(
        nearest["source"].alias("reply_to"), F.count("*").alias("n_linked")
    )


def _by_pieces(loose: DataFrame, sources: DataFrame) -> DataFrame:
    """``(conv_id, turn, depth, source)``: quotes with the latest earlier message that holds them whole, each
    paragraph as a paragraph or by all its lines."""
    one = ["conv_id", "turn", "depth", "key"]
    keyed = loose.groupBy("conv_id", "turn", "depth", F.sha2("text", 256).alias("key")).agg(
        F.count("*").alias("n"), F.first("text").alias("text")
    )
    folded = F.expr(_FOLDED.format("piece"))
    paragraphs = keyed.select(
        *one, "n", F.posexplode(F.expr("split(text, '\\n[ \\\\t]*\\n')")).alias("place", "piece")
    ).where(folded != "")
    lines = F.expr(
        f"array_distinct(filter(transform(split(piece, '\\n'), piece -> {_FOLDED.format('piece')}), "
        "piece -> piece <> ''))"
    )
    split = paragraphs.select(*one, "n", "place", folded.alias("paragraph"), lines.alias("lines"))
    count = F.count("*").over(Window.partitionBy(*one)).alias("n_paragraphs")
    split = split.select("*", F.size("lines").alias("n_lines"), count)
    pieces = split.select(
        *one, "n", "n_paragraphs", "n_lines", "place",
        F.posexplode(F.concat(F.array("paragraph"), F.col("lines"))).alias("i", "piece"),
    ).withColumn("hash", F.sha2("piece", 256))
    held = sources.select("conv_id", F.col("turn").alias("source"), "hash").distinct()
    # A message that holds the quote holds each paragraph, as one or by all lines. Those that may hold the
    # paragraph which fewest do are looked up first, and the other pieces are asked of them alone.
    spread = held.groupBy("conv_id", "hash").agg(F.count("*").alias("holders"))
    rare = pieces.join(spread, ["conv_id", "hash"], "left").withColumn("holders", F.coalesce("holders", F.lit(0)))
    as_one, by_lines = F.col("i") == 0, F.col("i") > 0
    keys = rare.groupBy(*one, "place").agg(
        F.max(F.when(as_one, F.struct("holders", "hash"))).alias("p"),
        F.min(F.when(by_lines, F.struct("holders", "hash"))).alias("l"),
    )
    cost = (F.col("p.holders") + F.col("l.holders")).alias("cost")
    rarest = keys.groupBy(*one).agg(F.min(F.struct(cost, "place", "p.hash", F.col("l.hash").alias("line"))).alias("r"))
    asked = rarest.select(*one, F.explode(F.array_distinct(F.array("r.hash", "r.line"))).alias("hash"))
    maybe = asked.join(held, ["conv_id", "hash"]).where("source < turn").select(*one, "source").distinct()
    pairs = pieces.join(maybe, one).join(held, ["conv_id", "source", "hash"])
    wholly = pairs.groupBy(*one, "n", "n_paragraphs", "n_lines", "place", "source").agg(
        F.min("i").alias("least"), F.count_if(F.col("i") > 0).alias("n_held")
    ).where("least = 0 or n_held = n_lines")
    holders = wholly.groupBy(*one, "n", "n_paragraphs", "source").agg(F.count("*").alias("k"))
    latest = holders.where("k = n_paragraphs").groupBy(*one, "n").agg(F.max("source").alias("source"))
    # Runs alike, as in repeated rows, count one by one.
    return latest.withColumn("copy", F.explode(F.expr("sequence(1, n)"))).select(
        "conv_id", "turn", "depth", "source"
    )


def _threads(links: DataFrame) -> DataFrame:
    """Adds ``thread``, the turn at which a chain of answers began; doubling, so few rounds."""
    known = checkpointed(links.withColumn("thread", F.col("reply_to")))
    while not known.isEmpty():
        ahead = known.select(
            F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("further")
        )
        at = (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t"))
        moved = checkpointed(known.join(ahead, at, "left").drop("c", "t"))
        known = moved.withColumn("thread", F.coalesce("further", "thread")).drop("further")
        if moved.where("further is not null").isEmpty():
            break
    return known


def linked(messages: DataFrame) -> DataFrame:
    """One row per message: ``(conv_id, turn, role, body, depth, n_quotes, n_linked, reply_to, thread)``.

    Sorted by ``thread`` and ``turn`` a conversation is in reply order: every answer stands after what it
    answers, within the thread that began with a message that answers none. ``reply_to`` is null where
    no quote is found again; such a message is a thread of its own. A quote is looked for in earlier
    turns only: as a whole line, paragraph or own text, else by its paragraphs and lines, all of which one
    message must hold; part of a line is not found. Null text counts as empty; a null conversation or turn links to nothing; of texts alike
    the latest is the source; repeated rows stay and link alike; an empty table gives no rows; other
    columns are ignored.
    """
    runs = parsed(messages)
    threads = _threads(_links(runs))
    rows = runs.select("conv_id", "turn", "role", "body", "depth", "n_quotes")
    return rows.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "depth", "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        "reply_to",
        F.coalesce("thread", "turn").alias("thread"),
    )


def conversations(messages: DataFrame) -> DataFrame:
    """``(conv_id, messages)``: each conversation in reply order, for chats of a size that one row holds."""
    said = F.struct("thread", "turn", "role", "body", "reply_to")
    rows = linked(messages).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("messages"))


def linked_sql(messages: str = "conversations") -> str:
    """The same in DuckDB, over a table or subquery, but for quotes found only by their pieces."""
    marks = "^(?:[ \\t]*>)+[ ]?"
    fold = "trim(regexp_replace(lower({0}), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"
    return f"""
    with recursive base as (select row_number() over () as r, conv_id, turn, role,
        string_split(coalesce(text, ''), chr(10)) as lines from {messages}),
    lined as (select r, conv_id, turn, unnest(lines) as line,
        unnest(range(len(lines))) as i from base),
    deep as (select r, conv_id, turn, i, length(translate(regexp_extract(line, '{marks}'), ' ' || chr(9), ''))
        as depth, regexp_replace(translate(line, chr(1) || chr(2), ''), '{marks}', '') as line from lined),
    runs as (select *, i - row_number() over (partition by r, depth order by i) as run from deep),
    parts as (select r, conv_id, turn, depth, min(i) as i, string_agg(line, chr(10) order by i) as text
      from runs group by r, conv_id, turn, depth, run),
    whole as (select r, coalesce(trim(string_agg(text, chr(10) order by i) filter (where depth = 0)), '')
        as body, max(depth) as depth, count(*) filter (where depth > 0) as n_quotes from parts group by r),
    sources as (select r, conv_id, turn, 0 as depth, body as part from base join whole using (r)
      union select r, conv_id, turn, 0, unnest(string_split(text, chr(10))) from parts where depth = 0
      union select r, conv_id, turn, 0, unnest(string_split_regex(text, '\\n[ \\t]*\\n')) from parts
        where depth = 0),
    units as (select conv_id, turn, depth, {fold.format("part")} as part from sources union all
      select conv_id, turn, depth, {fold.format("text")} from parts where depth > 0),
    found as (select q.conv_id, q.turn, q.depth, max(s.turn) as source, q.n from
      (select conv_id, turn, depth, part, count(*) as n from units where depth > 0 and part <> ''
        group by all) q
      join (select distinct conv_id, turn, part from units where depth = 0) s
        on q.conv_id = s.conv_id and q.part = s.part and s.turn < q.turn
      group by q.conv_id, q.turn, q.depth, q.part, q.n),
    links as (select conv_id, turn, arg_max(source, (-depth, source)) as reply_to, sum(n)::bigint as n_linked
      from found group by conv_id, turn),
    up as (select conv_id, turn, reply_to as thread from links
      union all select up.conv_id, up.turn, links.reply_to from up join links
        on up.conv_id = links.conv_id and up.thread = links.turn),
    threads as (select conv_id, turn, min(thread) as thread from up group by conv_id, turn)
    select b.conv_id, b.turn, b.role, w.body, w.depth::int as depth, w.n_quotes::int as n_quotes,
      coalesce(l.n_linked, 0)::bigint as n_linked, l.reply_to, coalesce(t.thread, b.turn) as thread
    from base b join whole w using (r) left join links l on b.conv_id = l.conv_id and b.turn = l.turn
      left join threads t on b.conv_id = t.conv_id and b.turn = t.turn
    """
