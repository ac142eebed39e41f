"""Registered queries; importing this package fills the registry."""

from tallyline.plans import audits, decode, enriched, state, streams, values  # noqa: F401
