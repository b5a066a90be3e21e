"""Codes and text keys of departures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def direction_code(direction_id: Column) -> Column:
    """I for outbound, V for inbound, C for circular and anything unknown."""
    return F.when(direction_id == "0", "I").when(direction_id == "1", "V").otherwise("C")


def compact_stamp(moment: Column) -> Column:
    """``YYYYMMDDHHMMSS``, without a detour through the session time zone."""
    return F.translate(F.substring(moment.cast("string"), 1, 19), "- :", "")


def trip_key_planned(servico: Column, sentido: Column, shape_id: Column,
                     moment: Column) -> Column:
    dash = F.lit("-")
    return F.concat(servico, dash, sentido, dash, shape_id, dash, compact_stamp(moment))


def trip_key_realised(id_viagem: Column) -> Column:
    """The trip id without the vehicle prefix that ends at its first dash."""
    return F.substr(id_viagem, F.instr(id_viagem, "-") + 1)
