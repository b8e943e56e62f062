"""tessera — lexicon, corpus and request-log analytics as Spark jobs.

Every public job takes DataFrames (plus plain parameters) and returns a
DataFrame.  Nothing collects to the driver; Catalyst plans the work.
"""

__version__ = "0.1.0"
