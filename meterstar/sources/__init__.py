"""Readers for raw trips, the zone lookup and the written warehouse."""
