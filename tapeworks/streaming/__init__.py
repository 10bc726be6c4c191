"""The same passes over growing folders.

Every function returns a started or finished query; checkpoints go to the
folder the caller names, which must be shared by all executors.
"""
