"""Registered queries, one module per inventory area. Importing this
package fills the registry in :mod:`vitalis.plans.registry`."""

from vitalis.plans.catalog import eda, functions, gates_reports, io_joins, learn, models, monitor, prep  # noqa: F401
