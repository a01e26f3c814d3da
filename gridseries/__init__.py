from . import config
