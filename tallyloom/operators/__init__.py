"""DataFrame -> DataFrame operators; none of them runs a job unless its docstring says so."""
