"""Training-data operators: near-dedup, language ID, token counts, quality
rules, source mixing, WARC archives, decontamination, substring dedup,
licence scans and a quality classifier.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks carry their code along, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
