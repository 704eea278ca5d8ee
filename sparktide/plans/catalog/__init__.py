"""All registered queries; importing this package fills the registry."""

from sparktide.plans.catalog import (  # noqa: F401
    auditing,
    capturing,
    changing,
    filtering,
    joining,
    ordering,
    reading,
    summarising,
)
