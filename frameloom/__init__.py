"""frameloom: frame sequences as Spark DataFrames.

A clip is one row of metadata and many scanlines; every operation is a lazy
DataFrame transform. ``operators`` holds the transforms, ``functions`` their
column expressions, ``sources`` readers and writers, ``plans`` the chain and the
command line, ``streaming`` the live delta coder.
"""
