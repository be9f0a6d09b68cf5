from . import build

build()
