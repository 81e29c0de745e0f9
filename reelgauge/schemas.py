"""Explicit schemas of every layer; nothing is inferred."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

RAW_CHANNEL = _struct(
    id=_S,
    snippet=_struct(title=_S, customUrl=_S, publishedAt=_S, country=_S),
    statistics=_struct(viewCount=_S, subscriberCount=_S, videoCount=_S),
    contentDetails=_struct(relatedPlaylists=_struct(uploads=_S)),
)

RAW_VIDEO = _struct(
    id=_S,
    snippet=_struct(
        title=_S,
        channelId=_S,
        channelTitle=_S,
        publishedAt=_S,
        thumbnails=_struct(high=_struct(url=_S)),
    ),
    contentDetails=_struct(duration=_S, definition=_S),
    statistics=_struct(viewCount=_S, likeCount=_S, commentCount=_S),
    extraction_date=_S,
)

PLAYLIST_PAGE = _struct(
    items=T.ArrayType(_struct(contentDetails=_struct(videoId=_S))),
    nextPageToken=_S,
)

BRONZE_CHANNEL = _struct(
    channel_id=_S,
    channel_name=_S,
    custom_url=_S,
    dt_published=_TS,
    country=_S,
    total_view=_L,
    total_subscriber=_L,
    total_video=_L,
    playlist=_S,
)

BRONZE_VIDEO = _struct(
    video_id=_S,
    title=_S,
    channel_id=_S,
    channel_name=_S,
    published_at=_TS,
    duration=_S,
    definition=_S,
    view_count=_L,
    like_count=_L,
    comment_count=_L,
    thumbnail_url=_S,
    extraction_date=_S,
    like_count_missing=T.BooleanType(),
    comment_count_missing=T.BooleanType(),
)

SILVER_VIDEO = _struct(
    video_id=_S,
    title=_S,
    channel_id=_S,
    channel_name=_S,
    published_at=_TS,
    duration=_D,
    definition=_S,
    view_count=_L,
    like_count=_L,
    comment_count=_L,
    thumbnail_url=_S,
    extraction_date=_S,
    like_count_missing=T.BooleanType(),
    comment_count_missing=T.BooleanType(),
    dia_semana=_S,
    hora_publicacao=_I,
    mes=_I,
    ano=_I,
    dia=_I,
    semana_do_ano=_I,
    ano_da_semana=_I,
    ano_mes_publish=_S,
    engagement_rate=_D,
    like_ratio=_D,
    comment_ratio=_D,
)

NICHE_BRIDGE = _struct(niche=_S, channel_id=_S)
SUGGESTION = _struct(channel_name=_S, dashboard=_S)
EVENT = _struct(
    event_id=_L, ts=T.TimestampNTZType(), user_id=_L, event_type=_S, value=_D, props=_S
)
