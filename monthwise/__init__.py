"""Monthly price series and bilateral trade cells as governed Spark tables.

Every public function takes DataFrames and returns a DataFrame.  Nothing runs
until the caller asks for an action, except the few functions whose name says
so (``write_*``, ``publish_*``).
"""
