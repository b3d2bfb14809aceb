"""Operators for preparing training data; nothing else in the library imports them."""

from __future__ import annotations
