"""histwright: warehouse history loading and fraud reporting on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function; only the
publishing layer (``histwright.plans``) runs actions.
"""

__version__ = "0.1.0"
