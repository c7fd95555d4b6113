"""Operators for large text corpora, and their registered queries.

Functions of this package travel to the workers by value, so a job needs the
package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
